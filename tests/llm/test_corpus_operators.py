"""Each operator on small tables with nulls, blanks, ties, repeated rows and clashing columns, against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortlens.llm import licenses, mixing, near_duplicates, neighbours, packing, quality, revisits, sharding, substrings, url_templates

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark, texts, extra=()):
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + list(extra), DOCS)


def sentence(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, short and very long texts, a null key, repeated rows, clashing column names."""
    rng = random.Random(1)
    base = sentence(rng, 300)
    edited = base.split()
    edited[7] = "changed"
    texts = [None, "", " \t\n", "one", "A b", base, base.upper(), " ".join(edited), sentence(rng, 30_000), base + " " + sentence(rng, 300)]
    again = [(5, base, None, "src1", 1), (None, base, "en", "src0", 2), (None, "apart from all others", "en", None, 3)]
    df = table(spark, texts, again)
    return df.withColumns({"node": F.lit("x"), "label": F.lit(1), "sig": F.lit(2), "words": F.lit("y"), "key": F.lit(0), "n": F.lit(0)})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_least_matches_hold_the_miss_probability():
    need = near_duplicates.least_matches(128, 32, 85, 1e-6)
    assert need[32] < need[64] < need[128] < 0.85 * 128
    rng = np.random.default_rng(0)
    assert (rng.binomial(128, 0.85, 100_000) < need[128]).mean() < 1e-4


def brute_near(rows, width, percent):
    sets = {}
    for k, (i, t) in enumerate(rows):
        w = (t or "").encode().lower().split()
        sets[k] = frozenset(tuple(w[j : j + width]) for j in range(max(1, len(w) - width + 1))) if w else frozenset()
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for k in sets:
        groups[find(k)].append(rows[k][0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[k][0], len(sets[k]), least[find(k)]) for k in sets), key=str)


def test_near_duplicates(spark, odd, empty):
    got = near_duplicates.near_duplicates(odd, shingle=3, percent=85).collect()
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_near(rows, 3, 85)
    assert all(r.kept == (r.component_id == r.doc_id) for r in got)
    assert near_duplicates.near_duplicates(empty).count() == 0


def test_near_duplicates_with_repeated_keys(spark):
    rng = random.Random(5)
    a, b = sentence(rng, 100), sentence(rng, 140)
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (3, b + " end")]
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_near(rows, 3, 85)


def test_near_duplicates_of_a_drifting_group(spark):
    rng = random.Random(2)
    base = sentence(rng, 120, 5000).split()
    rows = []
    for i in range(220):
        words = list(base)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute_near(rows, 3, 85)


def test_components_of_long_chains(spark):
    from cohortlens.functions.storage import Scratch
    from cohortlens.llm.graph import components

    edges = [(i, i + 1) for i in range(200)] + [(500, 500), (300, 301), (301, 300)]
    with Scratch(spark, "graph") as scratch:
        got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long"), scratch).collect()}
    assert got == {**{i: 0 for i in range(201)}, 300: 300, 301: 300}


def brute_repeats(rows, width):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            s = tuple(w[k : k + width])
            if s in seen:
                gone[k : k + width] = [True] * width
            seen.add(s)
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode())
    return out


@pytest.mark.parametrize("words,window", [(2, 5), (3, 20), (40, 20), (1, 20)])
def test_repeats_in_small_alphabets(spark, words, window):
    rng = random.Random(words)
    passage = sentence(rng, 60)
    rows = [(i, sentence(rng, rng.randrange(0, 200), words) + (" " + passage if i % 3 == 0 else "")) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substrings.drop_repeats(df, window=window, block_bytes=3000).collect()}
    assert got == brute_repeats(rows, window)


def test_repeats_of_odd_rows(odd, empty):
    got = substrings.drop_repeats(odd, carry=("label",)).collect()
    assert len(got) == odd.count() and {r.label for r in got} == {1}
    five = sorted(r.n_removed for r in got if r.doc_id == 5)
    assert five == [0, 300]  # of repeated rows one stays whole
    assert {r.kept_text for r in got if r.doc_id in (0, 1, 2)} == {""}
    assert substrings.drop_repeats(empty).count() == 0
    with pytest.raises(ValueError):
        substrings.drop_repeats(odd, carry=("text",))


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(3)
    for words in (2, 4, 1000):
        part = rng.integers(0, words, 20).astype(np.uint64)
        found = set()
        for _ in range(20):
            text = np.concatenate([rng.integers(0, words, 30).astype(np.uint64), part, rng.integers(0, words, 30).astype(np.uint64)])
            name, place = substrings.anchors(text, np.zeros(len(text), np.int64), 20)
            found.add((int(name[30]), int(place[30]) - 30))
        assert len(found) == 1


def test_packing_keeps_every_token_once(odd, empty):
    own = Tokenizer.from_file(TOKENIZER)
    want = collections.Counter(
        (r.doc_id, tuple(own.encode(r.text or "", add_special_tokens=False).ids) + (1,)) for r in odd.select("doc_id", "text").collect()
    )
    got = packing.pack(odd.repartition(40), TOKENIZER, with_ids=True, open_windows=4).collect()
    by_sequence = collections.defaultdict(list)
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces in by_sequence.values():
        assert [o for o, _ in sorted(pieces)] == list(np.cumsum([0] + [n for _, n in sorted(pieces)])[:-1])
        assert sum(n for _, n in pieces) <= packing.WINDOW
    single = {k: v for k, v in want.items() if k[0] not in (5, None)}
    for (doc, ids), _ in single.items():
        pieces = sorted((r.start, bytes(r.ids)) for r in got if r.doc_id == doc)
        assert b"".join(b for _, b in pieces) == np.array(ids, "<u4").tobytes()
    assert sum(r.length for r in got) == sum(len(ids) * n for (_, ids), n in want.items())
    assert packing.pack(empty, TOKENIZER).count() == 0


def test_token_cache_agrees_with_the_tokenizer():
    from cohortlens.llm.tokens import WordIds

    own = Tokenizer.from_file(TOKENIZER)
    texts = ["It's DON'T 'tis x's, 3.14! <|endoftext|> <|ENDOFTEXT|>. É́tude… ΣΑΣ a​b İi ﬁ ñ ½ 漢字, a-b_c (x) “q”", "", None, "...", "a" * 300]
    for limit in (2, 1000):
        ids = WordIds(TOKENIZER, limit)
        for _ in range(3):
            for t, b in zip(texts, ids.encode(texts), strict=True):
                assert np.frombuffer(b, "<u4").tolist() == own.encode(t or "", add_special_tokens=False).ids


def test_quality_rules(spark, odd, empty):
    rng = random.Random(4)
    clean = [sentence(rng, 200) for _ in range(300)]
    junk = [" ".join(w + "%%%" for w in sentence(rng, 200).split()) for _ in range(20)] + ["same line here\n" * 40 for _ in range(5)]
    got = {r.doc_id: r for r in quality.quality_rules(table(spark, clean + junk)).collect()}
    assert sum(got[i].kept for i in range(300)) >= 298
    assert not any(got[i].kept for i in range(300, 325))
    rows = quality.quality_rules(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in rows if r.doc_id in (0, 1, 2))
    assert quality.quality_rules(empty).count() == 0


def test_text_statistics(spark):
    texts = ["a b c a b c", "a a a a", "x\n\nx\n y\n y\n", "#tag $5 <b> é", "", None, "a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = [tuple(r)[1:] for r in quality.text_statistics(df, "text", ("i",)).orderBy("i").collect()]
    assert got == [(6, 6, 0, 1, 0, 6), (4, 4, 0, 1, 0, 4), (4, 4, 0, 4, 2, 0), (4, 10, 4, 1, 0, 0), (0, 0, 0, 0, 0, 0), (0, 0, 0, 0, 0, 0), (2, 2, 0, 1, 0, 0)]


def test_sharding(spark, odd, empty):
    for n in (1, 2, 3, 1000, 1025):
        place = sharding.permuted(np.arange(n), n)
        assert sorted(place) == list(range(n))
        assert (sharding.permuted(place, n, inverse=True) == np.arange(n)).all()
    got = sharding.shard(odd, shards=4).collect()
    sizes = collections.Counter(r.shard for r in got)
    assert len(got) == odd.count() and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in sizes.items())
    assert sorted(r.row_no for r in got) == list(range(len(got)))
    again = sharding.shard(odd.repartition(7), shards=4).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert sharding.shard(empty).count() == 0


def test_share_out(spark):
    rows = [("a", 10.0, 1.0, 100.0), ("b", 1000.0, 1.0, 100.0), ("c", 1000.0, 2.0, 100.0)]
    df = spark.createDataFrame(rows, "name string, cap double, weight double, budget double")
    got = {r["name"]: r["given"] for r in mixing.share_out(df, [], "name").collect()}
    assert got == {"a": 10.0, "b": 30.0, "c": 60.0}
    full = {r["name"]: r["given"] for r in mixing.share_out(df.withColumn("budget", F.lit(2010.0)), [], "name").collect()}
    assert full == {"a": 10.0, "b": 1000.0, "c": 1000.0}


def test_mixing(spark, odd, empty):
    texts = [sentence(random.Random(i), 50) for i in range(200)]
    df = table(spark, texts)
    got = mixing.mix(df, domain="case when source = 'src0' then 'x' else 'y' end", weights={"domain": {"x": 3}}, share=1.0).collect()
    words = collections.Counter()
    for r in got:
        words[r.domain] += r.n_tokens
    assert 7400 <= words["x"] <= 7600 and 2500 <= words["y"] <= 2700  # 10,000 words, three to one, whole documents
    times = collections.Counter(r.doc_id for r in got)
    assert max(times.values()) <= 2 and all(times[i] for i in range(0, 200, 2))
    assert mixing.mix(odd, domain="lang", weights={}, share=3.0).where("n_tokens = 0").count() == 0
    assert mixing.mix(empty, domain="lang", weights={}, share=1.0).count() == 0


def test_nearest_vectors(spark):
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((600, 24)) * rng.uniform(0.5, 3, (600, 1)))]
    rows += [(1000, rows[20][1]), (1001, rows[20][1]), (2000, None), (2001, []), (2002, [0.0] * 24), (2003, [float("nan")] * 24)]
    rows += [(2004, [None] * 24), (2005, [1.0, 2.0]), (None, rows[0][1]), (2020, [float("inf")] * 24)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = neighbours.nearest_vectors(df, df.where("vec_id % 20 = 0"), k=5).collect()
    good = {i: np.array(v) for i, v in rows if i is not None and v and len(v) == 24 and None not in v and np.isfinite(v).all() and any(v)}
    hits = total = 0
    for q in [i for i in good if i % 20 == 0]:
        scores = sorted(((-float((good[q] * v).sum()), i) for i, v in good.items() if i != q))[:5]
        found = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(s == float((good[q] * good[i]).sum()) for _, i, s in found)
        hits += len({i for _, i, _ in found} & {i for _, i in scores})
        total += 5
    assert hits / total >= 0.9
    assert {r.query_id for r in got} == {i for i in good if i % 20 == 0}
    tied = [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == 20][:2]
    assert tied == [1000, 1001]
    few = df.where("vec_id in (0, 1, 2)")
    assert neighbours.nearest_vectors(few, few.where("vec_id = 0")).count() == 2
    assert neighbours.nearest_vectors(df.limit(0), df.limit(0)).count() == 0


def test_licenses(spark, odd, empty):
    rng = random.Random(7)
    notice = licenses.TEMPLATES["gpl-3.0"]
    texts = [sentence(rng, k) + " " + notice.upper() + ", " + sentence(rng, 30) for k in range(0, 60, 3)]
    texts += [t for t in licenses.TEMPLATES.values()] + ["licensed under the public version", None, ""]
    got = {(r.doc_id, r.license): r for r in licenses.find_licenses(table(spark, texts).withColumn("license", F.lit("x"))).collect()}
    assert all(got[i, "gpl-3.0"].percent == 100 for i in range(20))
    assert {k for k in got if k[0] >= 20} == {(20 + j, name) for j, name in enumerate(licenses.TEMPLATES)}
    assert max(licenses.missed(len(t.split())) for t in licenses.TEMPLATES.values()) < 2e-4
    assert licenses.find_licenses(odd).count() == 0
    assert licenses.find_licenses(empty).count() == 0


def test_url_parts_and_rules(spark):
    from cohortlens.llm.queries import URL_RULES

    urls = ["http://A.Example.com/en/1?x", "https://www.example.com/en/", "ftp://b.net/es/#f", "http://x.net", "http://.net/fr/y", None, "no scheme", "http://com/", "http://acom/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_templates.filter_urls(df, labels, URL_RULES).collect()}
    assert got == {
        0: ("a.example.com", "/en/1", "example.com/en/", "block"), 1: ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        2: ("b.net", "/es/", "net/es/", "block"), 3: ("x.net", "", None, "allow"), 4: (".net", "/fr/y", "net/fr/", "block"),
        5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("com", "/", "com/", "allow"), 8: ("acom", "/", None, "allow"),
    }
    assert url_templates.filter_urls(df.limit(0), labels, URL_RULES).count() == 0


def test_bad_templates_are_blocked(spark):
    rows = [(i, f"http://h.org/{('good', 'bad', 'fine')[i % 3]}/{i}.html") for i in range(300)]
    rows += [(1000 + i, f"http://h.org/user{i}/page") for i in range(100)]
    labels = [(i, i % 3 == 1) for i in range(240)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: (r.template, r.verdict) for r in url_templates.filter_urls(df, spark.createDataFrame(labels, "page_id long, bad boolean"), ()).collect()}
    assert all(got[i] == (("/bad/*", "block") if i % 3 == 1 else got[i]) for i in range(300))
    assert all(got[i][1] == "allow" for i in range(300) if i % 3 != 1)
    assert len({got[i][0] for i in got if i >= 1000}) == 1


def test_branches_that_differ_stay_though_rare_or_numbered(spark):
    rows = [(i, f"http://big.org/dir-{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}/x", i % 2 == 0 and i % 7 == 0) for i in range(6000)]
    rows += [(10_000 + i, "http://big.org/rare/x", True) for i in range(40)]
    rows += [(20_000 + i, f"http://num.org/{('spam', 'doc', 'page')[i % 3]}-{i}", i % 3 == 0) for i in range(300)]
    labels = spark.createDataFrame([(i, bad) for i, _, bad in rows], "page_id long, bad boolean")
    df = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    got = {r.page_id: (r.template, r.verdict) for r in url_templates.filter_urls(df, labels, ()).collect()}
    assert {got[i] for i in got if 10_000 <= i < 20_000} == {("/rare/x", "block")}
    assert {got[i] for i in got if i >= 20_000 and i % 3 == 2} == {("/spam-#", "block")}  # 20000 % 3 == 2
    assert {got[i][1] for i in got if i < 10_000 or i >= 20_000 and i % 3 != 2} == {"allow"}


def test_branches_at_any_depth_are_told_apart(spark):
    deep = "/".join("abcdefghij")
    rows = [(i, f"http://deep.org/{deep}/{('good', 'bad')[i % 2]}/p{i}/end", i % 2 == 1) for i in range(200)]
    rows += [(1000, "http://one.org/" + "x/y7/" * 300, False), (1001, "http://one.org/", False), (1002, "http://deep.org/a/b", False)]
    labels = spark.createDataFrame([(i, bad) for i, _, bad in rows], "page_id long, bad boolean")
    df = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    got = {r.page_id: (r.template, r.verdict) for r in url_templates.filter_urls(df, labels, ()).collect()}
    assert {got[i] for i in range(1, 200, 2)} == {(f"/{deep}/bad/*/end", "block")}
    assert {got[i] for i in range(0, 200, 2)} == {(f"/{deep}/good/*/end", "allow")}
    assert got[1000] == ("/" + "/".join(["x/*"] * 300), "allow") and got[1001][0] == "/" and got[1002][0] == "/a/b"


def test_revisits(spark):
    def record(i, url, at, kind, etag=None, modified=None, headers=None):
        return (i, url, at, kind, etag, modified, None, 7 if kind == "response" else None, headers)

    schema = "record_id long, url string, at long, kind string, etag string, last_modified string, digest string, length long, headers map<string,string>"
    rows = [
        record(1, "http://www.a.org/x/?b=1&utm_source=f", 10, "response", "e1", headers={"date": "10", "content-type": "t"}),
        record(2, "https://A.org:443/x?b=1#top", 20, "revisit", "e1", headers={"date": "20", "content-type": "other"}),
        record(3, "http://a.org/x?b=1", 30, "revisit", "e2"), record(4, "http://a.org/x?b=1", 40, "revisit"),
        record(5, "http://a.org/x?b=1", 10, "revisit", "e1"), record(6, None, 50, "revisit", "e1"),
        record(7, "http://a.org/x?b=1", None, "revisit", "e1"), record(8, "http://a.org/other", 60, "revisit", "e1"),
        record(9, "http://a.org/x?b=1", 50, "metadata", "e1"),
    ]
    # one URL with very many records, spread over many ranges
    rows += [record(100 + i, "http://hot/", i, "response" if i % 97 == 0 else "revisit", f"e{i // 97}") for i in range(3000)]
    df = spark.createDataFrame(rows, schema).repartition(9).withColumn("base_id", F.lit("clash"))
    got = {r.record_id: r for r in revisits.resolve_revisits(df).collect()}
    assert {i: got[i].outcome for i in range(2, 9)} == {
        2: "resolved", 3: "mismatch", 4: "unverified", 5: "no response", 6: "no response", 7: "no response", 8: "no response"
    }
    assert got[2].headers == {"date": "20", "content-type": "t"} and got[2].response_id == 1 and got[2].length == 7
    assert all(got[100 + i].response_id == 100 + i // 97 * 97 for i in range(3000) if i % 97)
    assert 9 not in got and 1 not in got
    assert revisits.resolve_revisits(df.limit(0)).count() == 0


def test_pipeline_keeps_one_of_each_group(spark):
    import corpus_pipeline as cp

    rng = random.Random(9)
    clean = [sentence(rng, 150, 3000) for _ in range(120)]
    copy = clean[3].split()
    copy[5] = "other"
    rows = table(spark, clean + [clean[0], " ".join(copy), "%%% $$$ " * 100, None])
    kept = cp.reject_outliers(spark, rows, "")
    assert kept.columns == rows.columns and {r.doc_id for r in kept.collect()} >= set(range(118))
    assert not {122, 123} & {r.doc_id for r in kept.collect()}
    single = cp.drop_near_duplicates(spark, kept, "")
    assert {120, 121} & {r.doc_id for r in single.collect()} == set()
    cut = cp.drop_repeated_passages(spark, single, "")
    assert cut.columns == rows.columns
    mixed = cp.mix_sources(spark, cut, "")
    assert mixed.columns == rows.columns and mixed.count() > 0
    pieces = cp.pack_sequences(spark, mixed, "").collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in mixed.collect()}


def test_digest_of_kept_words(spark):
    from cohortlens.llm.queries import op7_drop_repeats

    got = op7_drop_repeats(spark, "/root/testdata/sf0.001").where("doc_id = 1").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id = 1").first().text
    if not got.n_removed:
        assert got.kept_sha256 == hashlib.sha256(b" ".join(text.encode().split())).hexdigest()
