import json

import pytest
from pyspark.sql import functions as F

from cohortlens import sources
from cohortlens.operators import ontology as on

URI = "http://purl.obolibrary.org/obo/HP_"


def document(tmp_path, **graph):
    path = tmp_path / "ontology.json"
    path.write_text(json.dumps({"graphs": [graph]}))
    return str(path)


def node(n, label, kind="CLASS", synonyms=(), definition=None):
    meta = {"synonyms": [{"pred": "any", "val": s} for s in synonyms]}
    if definition:
        meta["definition"] = {"val": definition}
    return {"id": f"{URI}{n:07d}", "type": kind, "lbl": label, "meta": meta}


def edge(sub, obj, pred="is_a"):
    return {"sub": f"{URI}{sub:07d}", "pred": pred, "obj": f"{URI}{obj:07d}"}


def test_document_to_terms(spark, tmp_path):
    path = document(
        tmp_path,
        nodes=[
            node(118, "Root"), node(1, " Seizure ", synonyms=["Fits", ""], definition="d"), node(2, "Deep"),
            node(3, "Other branch"), node(4, "  "), node(5, "Property", kind="PROPERTY"), {"id": f"{URI}0000006", "type": "CLASS"},
        ],
        edges=[edge(1, 118), edge(2, 1), edge(2, 118), edge(118, 2), edge(3, 118, "part_of"), edge(4, 1), edge(5, 1), edge(6, 1)],
        meta={"version": "http://purl.obolibrary.org/obo/hp/releases/2024-04-26/hp.json"},
    )
    ontology = sources.read_ontology(spark, path)
    members = on.subtree(ontology.edges)
    assert {r.id for r in members.collect()} == {"HP:0000118"} | {f"HP:000000{i}" for i in (1, 2, 4, 5, 6)}
    terms = on.build_terms(ontology.nodes, members)
    assert [(r.id, r.label, r.synonyms, r.definition) for r in terms.orderBy("ord").collect()] == [
        ("HP:0000118", "Root", [], ""), ("HP:0000001", "Seizure", ["Fits"], "d"), ("HP:0000002", "Deep", [], ""),
    ]
    pairs = on.label_synonym_pairs(terms).orderBy("vector_idx").collect()
    assert [(r.vector_idx, r.hpo_id, r.text) for r in pairs] == [
        (0, "HP:0000118", "Root"), (1, "HP:0000001", "Seizure"), (2, "HP:0000001", "Fits"), (3, "HP:0000002", "Deep"),
    ]
    assert tuple(on.ontology_stats(terms, ontology.version_url).first()) == ("2024-04-26", 3, 4)
    folder = str(tmp_path / "terms")
    sources.write_terms(terms, "2024-04-26", folder)
    back, release = sources.read_terms(spark, folder)
    assert back.count() == 3 and tuple(release.first()) == ("2024-04-26", 3)
    wanted = spark.createDataFrame([("HP:0000001",), ("HP:9",)], "hpo_id string")
    assert {(r.hpo_id, r.label) for r in on.lookup_terms(wanted, back).collect()} == {("HP:0000001", "Seizure"), ("HP:9", None)}


def test_root_without_edges(spark):
    edges = spark.createDataFrame([], "sub string, pred string, obj string")
    assert [r.id for r in on.subtree(edges, "HP:7").collect()] == ["HP:7"]


def test_ids_and_versions(spark):
    rows = spark.createDataFrame([("a/b/HP_1_HP_2", "x/releases/2024-01-02/y"), ("plain", "local"), ("a/UBERON_1", None)], "i string, v string")
    got = rows.select(on.node_id(F.col("i")), on.release_version(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [("HP:1_HP_2", "2024-01-02"), ("plain", "local"), ("UBERON_1", "unknown")]


def test_bad_documents(spark, tmp_path):
    with pytest.raises(Exception):
        sources.read_ontology(spark, str(tmp_path / "missing.json")).nodes.collect()
    broken = tmp_path / "broken.json"
    broken.write_text("{not json")
    with pytest.raises(Exception):
        sources.read_ontology(spark, str(broken)).nodes.collect()
    empty = tmp_path / "empty.json"
    empty.write_text('{"graphs": []}')
    with pytest.raises(Exception, match="no graphs"):
        sources.read_ontology(spark, str(empty)).nodes.collect()
    terms = tmp_path / "terms.json"
    terms.write_text(json.dumps({"version": "v", "terms": [{"id": "HP:1"}]}))
    with pytest.raises(Exception, match="without label"):
        sources.read_terms(spark, str(terms), document=True)[0].collect()


def test_term_document_defaults(spark, tmp_path):
    path = tmp_path / "terms.json"
    path.write_text(json.dumps({"version": "v", "terms": [{"id": "HP:1", "label": "A"}]}))
    terms, release = sources.read_terms(spark, str(path), document=True)
    assert tuple(terms.first()) == ("HP:1", "A", [], "") and tuple(release.first()) == ("v", 1)


def test_cues_gold_and_notes(spark, tmp_path):
    cues = tmp_path / "cues.json"
    cues.write_text(json.dumps({"preceding_negations": ["never", "no sign of"]}))
    assert {tuple(r) for r in sources.read_cues(spark, str(cues)).collect()} == {("preceding", "never"), ("preceding", "no sign of")}
    cues.write_text(json.dumps({"preceding_negations": "never"}))
    with pytest.raises(Exception):
        sources.read_cues(spark, str(cues)).collect()
    gold = tmp_path / "gold.json"
    gold.write_text(json.dumps([{"note": "a", "expected_mentions": [{"text": "x", "hpo_id": "H"}]}, {"note": "b", "expected_mentions": []}]))
    rows = sources.read_gold(spark, str(gold)).orderBy("case_id").collect()
    assert [(r.note, r.pos, r.text, r.hpo_id, r.negated) for r in rows] == [("a", 0, "x", "H", False), ("b", None, None, None, None)]
    gold.write_text(json.dumps([{"note": "a", "expected_mentions": [{"text": "x"}]}]))
    with pytest.raises(Exception, match="without hpo_id"):
        sources.read_gold(spark, str(gold)).collect()
    folder = tmp_path / "notes"
    folder.mkdir()
    (folder / "one.txt").write_text("line 1\nline 2\n")
    (folder / "two.txt").write_text("No pain.")
    assert {tuple(r) for r in sources.read_notes(spark, str(folder)).collect()} == {("one.txt", "line 1\nline 2\n"), ("two.txt", "No pain.")}


def test_subtree_of_long_chains_cycles_and_ladders(spark, monkeypatch):
    """Rounds grow with the digits of the depth; the result is that of a plain search."""
    import random

    written = []
    table = on.Scratch.table
    monkeypatch.setattr(on.Scratch, "table", lambda self, df, name: written.append(name) or table(self, df, name))
    chain = [(f"n{i + 1}", f"n{i}") for i in range(5000)]
    links = spark.createDataFrame(chain, "sub string, obj string").withColumn("pred", F.lit("is_a"))
    assert on.subtree(links, "n0").count() == 5001
    assert written.count("jumps") <= 15

    rng = random.Random(3)
    for trial in range(4):
        pairs = [(f"n{rng.randrange(60)}", f"n{rng.randrange(60)}") for _ in range(70)]
        pairs += [(f"l{i + 1}{s}", f"l{i}{t}") for i in range(9) for s in "ab" for t in "ab"] + [("l0a", "n0"), ("n0", "l9b")]
        pairs += [("x1", "x0"), ("x0", "x1"), ("n1", "x1"), ("a0", None), (None, "n0"), ("n0", "n0")]
        below, reached = {}, {"n0"}
        for sub, obj in pairs:
            below.setdefault(obj, set()).add(sub)
        todo = ["n0"]
        while todo:
            fresh = {s for s in below.get(todo.pop(), ()) if s is not None} - reached
            reached |= fresh
            todo += fresh
        frame = spark.createDataFrame(pairs, "sub string, obj string").withColumn("pred", F.lit("is_a"))
        got = [r.id for r in on.subtree(frame, "n0").collect()]
        assert len(got) == len(set(got)) and set(got) == reached, trial


def test_no_join_passes_through_the_driver(spark, monkeypatch):
    plans = []

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    table = on.Scratch.table
    monkeypatch.setattr(on.Scratch, "table", lambda self, df, name: table(self, planned(df), name))
    edges = spark.createDataFrame([(f"x/HP_{i}", "is_a", f"x/HP_{i // 2}") for i in range(1, 40)], "sub string, pred string, obj string")
    members = on.subtree(edges, "HP:1")
    assert members.count() == 39
    meta = "meta struct<synonyms:array<struct<pred:string,val:string>>,definition:struct<val:string>>"
    nodes = spark.createDataFrame([(i, f"x/HP_{i}", "CLASS", f"t{i}", None) for i in range(50)], f"ord int, id string, type string, lbl string, {meta}")
    terms = on.build_terms(nodes, members)
    asked = spark.createDataFrame([("HP:7",), ("HP:0",)], "hpo_id string")
    found = planned(on.lookup_terms(asked, terms)).select("hpo_id", "label").collect()
    assert sorted(map(tuple, found)) == [("HP:0", None), ("HP:7", "t7")]
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)
