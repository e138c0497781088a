import hashlib
import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from paperloom import catalog
from paperloom.functions import bits
from paperloom.operators import dedup, reports, store
from paperloom.sources import exports, layout_json
from paperloom.streaming import new_papers

SF = "/root/testdata/sf0.001"


def short(x):
    return hashlib.sha256(x.encode()).hexdigest()[:16]


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{SF}/{name}'")
    return con


def plain(v):
    if str(v) in ("None", "nan", "<NA>", "NaT"):
        return "null"
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_its_sql(spark, oracle, name):
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), oracle.sql(catalog.ORACLE_SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = [sorted(tuple(plain(v) for v in r) for r in f[columns].itertuples(index=False, name=None)) for f in (got, want)]
    assert rows[0] == rows[1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


IDS = "paper_id string, block_id string, source_position_key string, text_fingerprint string, latex_fingerprint string, asset_signature string"


def identity(paper, n, text="t", latex="", asset="", path="a/b"):
    return (paper, f"{paper}{n}", f"{paper}#{path}#{n}", text, latex, asset)


def test_groups_need_several_papers(spark):
    rows = [identity("p", 1), identity("p", 2), identity("q", 1, "u"), identity("r", 1, "u", path=""), identity("s", 1, ""), identity("t", 1, "")]
    (g,) = dedup.candidate_groups(spark.createDataFrame(rows, IDS)).collect()
    assert g.fingerprint == "u" and g.id == f"dcg_{short('u')}" and g.candidate_count == 2 and g.max_similarity == pytest.approx(0.25)
    assert [i.section_path for i in g["items"]] == ["a/b", ""]


def test_trimming_keeps_the_most_alike(spark):
    rows = [identity(f"p{i:02}", 1, latex="same" if i % 2 else f"own{i}") for i in range(30)]
    kept = dedup.trimmed(dedup.with_paths(dedup.candidate_items(spark.createDataFrame(rows, IDS))), 15)
    assert {r.paper_id for r in kept.collect()} == {f"p{i:02}" for i in range(1, 30, 2)}


def test_average_is_that_of_all_pairs(spark):
    rows = [identity(f"p{i}", i, latex="xy"[i % 2] if i % 3 else "", asset="z" if i < 4 else "", path="/".join("abc"[: i % 4])) for i in range(9)]
    items = dedup.with_paths(dedup.candidate_items(spark.createDataFrame(rows, IDS)))
    pairs = dedup.pairs(items).collect()
    got = {r.block_id: r.avg_score for r in dedup.average_scores(items).collect()}
    for i in range(9):
        mine = [p.score for p in pairs if i in (p.i, p.j)]
        assert got[f"p{i}{i}"] == pytest.approx(sum(mine) / 8)


def test_visual_groups_are_greedy(spark):
    h = lambda x: format(x, "016x")
    rows = [("a", "p1", "image", h(0)), ("b", "p2", "image", h(1)), ("c", "p3", "image", h(0b111)), ("d", "p4", "image", h(0b11111)), ("e", "p5", "table", h(0)), ("f", "p1", "image", h(0)), ("g", "p9", "image", ""), ("x", "p7", "image", h(2**64 - 1))]
    made = dedup.visual_groups(spark.createDataFrame(rows, "id string, paper_id string, asset_type string, perceptual_hash string"), 2).collect()
    # a and f are in one paper; c is near b, and d near c alone.
    assert [(r.members, r.min_distance, r.max_distance) for r in made] == [(["a", "b", "c", "d", "f"], 1, 2)]


def test_visual_groups_are_those_of_one_greedy_pass(spark):
    """Against a single pass over all edges of a type, over random hashes with many ties."""
    import random

    rng = random.Random(8)
    rows = []
    for seed in range(25):
        base = rng.getrandbits(64)
        for i in range(rng.randint(1, 9)):
            value = base
            for _ in range(rng.randint(0, 5)):
                value ^= 1 << rng.randrange(64)
            rows.append((f"a{len(rows):03d}", f"p{rng.randrange(5)}", rng.choice(("image", "table")), format(value, "016x")))
    far = lambda x, y: bin(int(x, 16) ^ int(y, 16)).count("1")
    want = []
    for kind in ("image", "table"):
        of = sorted(r for r in rows if r[2] == kind)
        edges = sorted((far(x[3], y[3]), x, y) for i, x in enumerate(of) for y in of[i + 1 :] if x[1] != y[1] and far(x[3], y[3]) <= 8)
        at, groups = {}, []
        for d, x, y in edges:
            if x in at and y in at:
                continue
            g = at.get(x, at.get(y))
            if g is None:
                g = ({}, [])
                groups.append(g)
            for z in (x, y):
                if z not in at:
                    at[z] = g
                    g[0][z] = True
            g[1].append(d)
        want += [(kind, tuple(sorted(z[0] for z in m)), min(d), max(d), round(sum(d) / len(d), 9)) for m, d in groups if len({z[1] for z in m}) >= 2]
    made = dedup.visual_groups(spark.createDataFrame(rows, "id string, paper_id string, asset_type string, perceptual_hash string"))
    got = [(r.asset_type, tuple(r.members), r.min_distance, r.max_distance, round(r.avg_distance, 9)) for r in made.collect()]
    assert sorted(got) == sorted(want) and len(want) > 10


def test_hash_distance(spark):
    rows = spark.createDataFrame([("ffffffffffffffff", "0000000000000000"), ("8000000000000001", "0000000000000001")], "a string, b string")
    assert [r[0] for r in rows.select(bits.hamming(F.col("a"), F.col("b"))).collect()] == [64, 1]
    with pytest.raises(Exception):
        spark.createDataFrame([("ff", "f")], "a string, b string").select(bits.hamming(F.col("a"), F.col("b"))).collect()


def test_average_hash():
    import numpy as np

    pixels = np.zeros((64, 64))
    pixels[:32] = 255
    assert bits.average_hash(pixels) == "ffffffff00000000" and bits.average_hash(np.full((9, 30), 7)) == "f" * 16


def test_asset_groups(spark):
    rows = [("a", "p", "image", "h"), ("b", "q", "image", "h"), ("c", "p", "image", "i"), ("d", "p", "image", "i"), ("e", "p", "image", "m"), ("f", "q", "table", "m"), ("g", "p", "image", ""), ("h", "q", "image", "")]
    got = dedup.asset_groups(spark.createDataFrame(rows, "id string, paper_id string, asset_type string, content_hash string")).collect()
    assert [(r.content_hash, r.representative, r["size"]) for r in got] == [("h", "a", 2)]


def test_workflow(spark, tmp_path):
    db = store.Store(spark, str(tmp_path / "db"))
    assert len(db.init()) == 17 and db.missing() == [] and db.init() == []
    rows = [identity("p", 1), identity("q", 1), identity("r", 2, "u"), identity("s", 2, "u")]
    groups = dedup.candidate_groups(spark.createDataFrame(rows, IDS))
    db.save_groups(groups)
    db.save_groups(groups)
    assert db.read("duplicate_candidate_items").count() == 4 and db.duplicate_groups().count() == 2
    first = f"dcg_{short('t')}"
    decision = spark.createDataFrame([(first, "same", "ann", ""), (f"dcg_{short('u')}", "different", "ann", "")], "group_id string, decision string, reviewer string, reason string")
    db.decide(decision)
    db.decide(decision)
    assert db.read("duplicate_review_decisions").count() == 2
    (canon,) = db.canonicalize("ann").collect()
    assert canon.id == f"cqn_{short(first)}" and canon.canonical_fingerprint == short("t") and canon.representative_item_id == "p1"
    assert db.canonicalize("ann").count() == 1 and db.read("canonicalization_events").count() == 1
    assert {r.id: r.status for r in db.duplicate_groups().collect()} == {first: "resolved", f"dcg_{short('u')}": "pending"}
    db.rollback(db.read("canonical_questions"), "ann")
    assert db.canonical_questions("reverted").count() == 1 and {r.is_active for r in db.read("question_variants").collect()} == {False}
    db.canonicalize("ann")
    assert {r.is_active for r in db.read("question_variants").collect()} == {True}
    assert sorted(r.event_type for r in db.read("canonicalization_events").collect()) == ["created", "reactivated", "reverted"]
    assert len(db.canonical_question(canon.id).first().variants) == 2 and len(db.duplicate_group(first).first().decisions) == 1
    db.save_groups(groups)
    assert db.duplicate_groups("pending").count() == 2


def test_a_failed_commit_leaves_everything_in_place(spark, tmp_path, monkeypatch):
    db = store.Store(spark, str(tmp_path / "db"))
    db.init()
    paper = lambda i: spark.createDataFrame([(i, f"title {i}")], "id string, title string")
    db.upsert("papers", paper("a"))
    # The rename of the commit fails: neither this process nor a new one sees the change.
    with monkeypatch.context() as m:
        commits = store.Store._commits
        taken = f"{db.path}/_commits/{int(commits(db)[-1]) + 1:020d}"
        import os

        os.makedirs(taken)
        m.setattr(store.Store, "_commits", lambda self: [c for c in commits(self) if not taken.endswith(c)])
        with pytest.raises(RuntimeError):
            db.upsert("papers", paper("b"))
        assert [r.id for r in db.read("papers").collect()] == ["a"]
        os.rmdir(taken)
    assert [r.id for r in store.Store(spark, str(tmp_path / "db")).read("papers").collect()] == ["a"] and db.init() == []
    # A step that breaks in its middle changes no table.
    with pytest.raises(ZeroDivisionError), db.step():
        db.upsert("papers", paper("c"))
        assert db.read("papers").count() == 2
        raise ZeroDivisionError
    assert db.read("papers").count() == 1
    n = len(db._commits())
    with db.step():
        db.upsert("papers", paper("d"))
        db.upsert("papers", paper("e"))
    assert db.read("papers").count() == 3 and len(db._commits()) == n + 1


def test_versions_without_a_commit_are_not_a_missing_table(spark, tmp_path):
    import shutil

    db = store.Store(spark, str(tmp_path / "db"))
    db.init()
    db.upsert("papers", spark.createDataFrame([("a",)], "id string"))
    shutil.rmtree(tmp_path / "db" / "_commits")
    with pytest.raises(ValueError):
        db.init()


def test_ingestion_is_saved_in_one_step(spark, tmp_path):
    from paperloom.plans.ingest import from_markdown

    text = "一、选择题\n1. 计算 $x$ 的值\nA. 1\nB. 2\nC. 3\nD. 4\n2. 求证\n参考答案\n1. 答案：A\n2. 略"
    rows = from_markdown(spark.createDataFrame([("p", text)], "paper_id string, markdown string"))
    db = store.Store(spark, str(tmp_path / "db"))
    db.init()
    n = len(db._commits())
    for _ in range(2):
        db.save_result(spark.createDataFrame([("p", "Paper")], "id string, title string"), rows)
    assert len(db._commits()) == n + 2
    questions = {r.id: r for r in db.read("questions").collect()}
    assert len(questions) == 2 and {r.question_block_id for r in questions.values()} == {r.id for r in db.read("question_blocks").collect()}
    assert sorted(r.label for r in db.read("choices").collect()) == list("ABCD")
    assert db.read("quality_reports").count() == 2 and db.review_queue().count() == sum(r.needs_review for r in db.read("quality_reports").collect())


def test_canonical_assets_and_lookups(spark, tmp_path):
    db = store.Store(spark, str(tmp_path / "db"))
    db.init()
    rows = [("a", "p", "image", "h"), ("b", "q", "image", "h"), ("c", "p", "image", "i"), ("d", "q", "table", "i"), ("e", "r", "image", "h")]
    db.upsert("raw_assets", spark.createDataFrame(rows, "id string, paper_id string, asset_type string, content_hash string"))
    (canon,) = db.generate_canonical_assets().collect()
    assert canon.id == f"ca_{short('h')}" and canon.asset_fingerprint == short("h") and canon.representative_raw_asset_id == "a"
    assert [r.id for r in db.assets_with_content("h").collect()] == ["a", "b", "e"]
    assert [v.raw_asset_id for v in db.canonical_asset(canon.id).first().variants] == ["a", "b", "e"]
    assert db.canonical_assets().count() == 1 and db.asset_candidates()["variants"].count() == 3
    assert db.canonical_of_group("none").count() == 0


def test_upsert_changes_listed_columns(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, u string, v string")
    new = spark.createDataFrame([(2, "B", None), (3, "C", "z")], "k int, u string, v string")
    got = store.upsert(old, new, ("k",), ("u",)).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, "a", "x"), (2, "B", "y"), (3, "C", "z")]


def test_layout_files_of_all_shapes(spark, tmp_path):
    flat = [{"id": "a", "page": 1, "type": "text", "bbox": [0, 0, 1, 1], "text": "x"}]
    item = {"type": "text", "page_idx": 2, "bbox": [0, 0, 500, 1000], "text": " hi ", "confidence": 0}
    listed = [item, {**item, "bbox": [1, 1, 1, 1]}, {"type": "list", "page_idx": 0, "bbox": [0, 0, 1, 1], "list_items": ["a", "b"]}, {"type": "equation", "page_idx": -1, "bbox": [0, 0, 9, 9], "text": "", "content": ["$x$", "$y$"]}]
    paged = [[{**item, "page_idx": None}], [{"type": "chart", "bbox": [0, 0, 1, 1], "img_caption": "cap"}]]
    files = spark.createDataFrame([("flat", json.dumps(flat)), ("listed", json.dumps(listed)), ("paged", json.dumps(paged)), ("empty", "[]")], "paper_id string, text string")
    got = {(r.paper_id, r.id): r for r in layout_json.elements(files).collect()}
    assert set(got) == {("flat", "a"), ("listed", "m000001"), ("listed", "m000003"), ("listed", "m000004"), ("paged", "m000001"), ("paged", "m000002")}
    assert got["listed", "m000001"].bbox == [0, 0, 0.5, 1] and got["listed", "m000001"].page == 3 and got["listed", "m000001"].confidence == 1
    assert got["listed", "m000003"].text == "a\nb" and got["listed", "m000004"].text == "$x$\n$y$" and got["listed", "m000004"].page == 1
    assert got["listed", "m000004"].type == "formula" and got["paged", "m000002"].page == 2 and (got["paged", "m000002"].type, got["paged", "m000002"].text) == ("figure", "cap")
    with pytest.raises(Exception):
        layout_json.elements(spark.createDataFrame([("odd", '[{"x": 1}]')], "paper_id string, text string")).collect()


def test_files_are_found(spark, tmp_path):
    for name, body in (("a/x_middle.json", "1"), ("a/x_content_list.json", "2"), ("b/z.json", "3"), ("b/y.json", "4"), ("c/output.json", "5"), ("c/output.md", "# T\nx"), ("d/output.json", "6")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(body)
    (tmp_path / "e.pdf").write_bytes(b"/Type /Page \xff /Type/Pages /Type /Page\n")
    chosen = {r.text for r in layout_json.chosen_files(layout_json.files(spark, str(tmp_path), "*.json")).collect()}
    assert chosen == {"2", "4", "5", "6"}
    assert [r.paper_id.split("/")[-1] for r in layout_json.paper_folders(spark, str(tmp_path)).collect()] == ["c"]
    assert layout_json.markdown(spark, str(tmp_path)).first().markdown == "# T\nx"
    assert layout_json.pdf_page_counts(spark, str(tmp_path)).first().pages == 2
    assert exports.recent_reports(spark, str(tmp_path)).first().title == "T"


def test_exports_read_back(spark, tmp_path):
    kind = "array<struct<label:string,content_latex:string>>"
    rows = [("p", 1, 1, "proof", "stem", [("A", "x")], ""), ("p", 2, 2, "single_choice", " ", [], "B")]
    q = spark.createDataFrame(rows, f"paper_id string, ord int, n int, question_type string, stem_latex string, choices {kind}, answer_latex string")
    exports.write_json(q, str(tmp_path / "json"))
    back = exports.read_json(spark, str(tmp_path / "json"), f"n int, question_type string, stem_latex string, choices {kind}, answer_latex string").collect()
    assert [(r.paper_id, r.n, r.stem_latex) for r in back] == [("p", 1, "stem")]
    made = exports.paper_markdown(q, F.lit("T: 1")).first()
    assert made.file_name == "T_1" and made.paper.startswith("# T: 1\n\n1. stem\nA. x") and made.answers.endswith("2. B\n") and exports.NO_ANSWER in made.answers


def test_reports(spark):
    steps = spark.createDataFrame([("p", "a", "success"), ("p", "b", "failed"), ("q", "a", "failed"), ("r", "a", "success"), ("s", "a", "success")], "paper_id string, step string, status string")
    gates = spark.createDataFrame([("r", "failed"), ("s", "failed"), ("s", "pass")], "paper_id string, gate string")
    assert {r.paper_id: r.status for r in reports.run_status(steps, ("a",), gates).collect()} == {"p": "partial", "q": "failed", "r": "partial", "s": "completed"}
    totals = spark.createDataFrame([(10, 8, 1, 1, 100, 10, 0, 5, 10, 9, 1, 0, 0, 0, 0)], "papers int, completed int, partial int, failed int, questions int, warned int, failed_questions int, papers_with_assets int, assets int, links int, unlinked int, broken_links int, crops int, crops_failed int, hashes int")
    r = reports.acceptance_gates(totals).first()
    assert r.g_success and r.g_warnings and r.g_crops and not r.g_no_failed and not r.accepted


def test_asset_metrics(spark):
    assets = spark.createDataFrame([("a", "p", "image"), ("b", "p", "figure"), ("c", "p", "table"), ("d", "q", "image")], "id string, paper_id string, asset_type string")
    links = spark.createDataFrame([("a", "x", 0.9), ("d", "y", 0.5)], "raw_asset_id string, question_id string, confidence double")
    blocks = spark.createDataFrame([("x",)], "id string")
    got = {r.paper_id: (r.assets, r.links, r.weak_links, r.unlinked, r.broken_links) for r in reports.asset_metrics(assets, links, blocks).collect()}
    assert got == {"p": (3, 1, 0, 1, 0), "q": (1, 1, 1, 0, 1)}


def test_comparison(spark):
    schema = "paper_id string, question_number string"
    old, new = spark.createDataFrame([("p", "1"), ("p", "2"), ("p", "10"), ("p", "例1")], schema), spark.createDataFrame([("p", "2"), ("p", "3")], schema)
    (r,) = reports.compared(old, new).collect()
    assert (r.both, r.only_old, r.only_new) == (1, ["例1", "1", "10"], ["3"])


def test_stream_equals_table(spark, tmp_path):
    rows = [(i, f"p{i % 3}", f"text {i % 5}") for i in range(20)]
    schema = "block_id long, paper_id string, text string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    new_papers.keep(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, new_papers.identified(spark.createDataFrame(rows, schema)).collect()))


def test_registered_queries_have_the_rows_their_sql_leaves_out(spark, tmp_path):
    from paperloom import catalog

    docs = [(1, r"costs \$5", "en", "src0", 9), (2, r"$\frac{1}{2}$ and $x", "en", "src0", 21), (3, "plain", "en", "src0", 5)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 0, 0) for i in (1, 2, 3)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "MinerU", "failed")], "event_id long, event_type string, props string").write.parquet(str(tmp_path / "events.parquet"))
    rows = lambda name: catalog.QUERIES[name](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.unbalanced for r in rows("text_features")} == {1: False, 2: True, 3: False}
    assert {r.question_id for r in rows("validated_questions")} == {r.question_id for r in rows("review_queue")} == {1, 2, 3}
    assert [r["class"] for r in rows("failure_classes")] == ["mineru_non_transient"]
