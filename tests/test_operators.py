import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.operators import audit, chunking, incremental, migrate, retrieval, summary, upsert


def model_pack(paras, target, overlap):
    """The packing rule, said again over Python lists."""
    out, cur = [], []
    for p in paras:
        if len(p) > target:
            out += [cur] * bool(cur) + [p[i : i + target] for i in range(0, len(p), target - overlap)]
            cur = []
        elif len(cur) + len(p) > target:
            out += [cur] * bool(cur)
            cur = (cur[-overlap:] if overlap else []) + p
        else:
            cur = cur + p
    return [" ".join(c) for c in out + [cur] * bool(cur)]


def test_pack_matches_model(spark):
    @settings(max_examples=25, deadline=None)
    @given(st.lists(st.lists(st.integers(0, 25), min_size=0, max_size=8), min_size=1, max_size=12), st.integers(2, 9), st.data())
    def check(docs, target, data):
        overlap = data.draw(st.integers(0, target - 1))
        texts = ["\n\n".join(" ".join(f"w{i}.{j}" for j in range(n)) for i, n in enumerate(d)) for d in docs]
        df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
        got = {}
        for r in chunking.chunk_texts(df, "text", target, overlap).orderBy("id", "chunk_index").collect():
            got.setdefault(r.id, []).append(r.text)
        for i, t in enumerate(texts):
            assert got.get(i, []) == model_pack([p.split() for p in t.split("\n\n") if p.split()], target, overlap)

    check()


@pytest.mark.parametrize("n,starts", [(320, [0]), (380, [0, 320]), (700, [0, 320, 640]), (1, [0]), (0, [])])
def test_hard_split(spark, n, starts):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(n)))], "id int, text string")
    assert [r.text.split()[0] for r in chunking.hard_split(df, "text").orderBy("chunk_index").collect()] == [f"w{s}" for s in starts]


def test_overlap_must_be_less_than_target():
    with pytest.raises(ValueError):
        chunking.packed(None, 5, 5)


FEED = "id string, seq long, at timestamp, h string, path string"
T = [dt.datetime(2025, 1, d) for d in range(1, 10)]


def test_upsert_outcomes_and_snapshot(spark):
    feed = spark.createDataFrame([("a", 1, T[0], "x", "p1"), ("a", 2, T[1], "x", None), ("a", 3, T[2], "y", None), ("b", 4, T[3], None, None), ("b", 5, T[4], None, "q")], FEED)
    got = [r.outcome for r in upsert.outcomes(feed, "id", "seq", "h").orderBy("seq").collect()]
    assert got == ["inserted", "unchanged", "updated", "inserted", "unchanged"]
    first = upsert.snapshot(feed, "id", "seq", "at", "h", ["h"], ["path"])
    rows = {r.id: r for r in first.collect()}
    assert (rows["a"].h, rows["a"].path, rows["a"].first_seen_at, rows["a"].last_seen_at, rows["a"].updated_at) == ("y", "p1", T[0], T[2], T[2])
    assert (rows["b"].h, rows["b"].path, rows["b"].updated_at) == (None, "q", T[3])
    # An update whose download failed keeps the path; an id that is not fed passes through; the same feed again changes nothing.
    more = spark.createDataFrame([("a", 1, T[5], "z", None), ("c", 2, T[6], "n", None)], FEED)
    rows = {r.id: r for r in upsert.snapshot(more, "id", "seq", "at", "h", ["h"], ["path"], first).collect()}
    assert (rows["a"].h, rows["a"].path, rows["a"].first_seen_at, rows["a"].updated_at) == ("z", "p1", T[0], T[5])
    assert rows["b"].path == "q" and rows["c"].first_seen_at == T[6]
    again = spark.createDataFrame([("a", 1, T[7], "y", None), ("b", 2, T[7], None, None)], FEED)
    assert {r.outcome for r in upsert.outcomes(again, "id", "seq", "h", first).collect()} == {"unchanged"}


@pytest.mark.parametrize("ranges", [2, 7])
def test_ranges_of_a_hot_key_agree(spark, ranges):
    feed = spark.range(300).select(F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 11).cast("string")).alias("id"), F.col("id").alias("seq"), F.when(F.col("id") % 7 > 0, (F.col("id") / 5).cast("int").cast("string")).alias("h"))
    stored = spark.createDataFrame([("hot", None), ("3", "0"), ("z", "1")], "id string, h string")
    for old in (None, stored):
        one, many = (sorted(map(tuple, upsert.outcomes(feed, "id", "seq", "h", old, n).collect())) for n in (1, ranges))
        assert one == many and len(one) == 300


def test_set_fields(spark):
    t = spark.createDataFrame([("a", "1"), ("b", "2")], "id string, v string")
    p = spark.createDataFrame([("a", "9"), ("z", "8")], "id string, v string")
    assert sorted(map(tuple, upsert.set_fields(t, p, "id", ["v"]).collect())) == [("a", "9"), ("b", "2")]


def test_incremental(spark):
    cols = "id string, content_hash string, judgment_pdf_sha256 string, sc_judgment_pdf_sha256 string"
    records = spark.createDataFrame([("a", "1", "s", None), ("b", "1", None, "t"), ("c", "2", None, None)], cols)
    state = spark.createDataFrame([("a", "1", "s", None, 1, None), ("b", "1", None, None, None, None)], cols + ", judgment_chunk_count int, sc_judgment_chunk_count int")
    got = {r.id: (r.content_hash_changed, r.is_new) for r in incremental.changed_pieces(records, state, ["content_hash"]).collect()}
    assert got == {"a": (False, False), "b": (False, False), "c": (True, True)}
    assert [tuple(r) for r in incremental.pending_documents(records, state).collect()] == [("b", "sc_judgment_pdf", "t")]


def test_shrink_and_replace(spark):
    index = spark.createDataFrame([(f"r::k::{i}", "r", "k", i, "old") for i in range(4)], "chunk_id string, record_id string, chunk_type string, chunk_index int, text string")
    counts = spark.createDataFrame([("r", "k", 2)], "record_id string, chunk_type string, n_chunks int")
    gone = incremental.trailing_chunks(index, counts)
    assert sorted(r.chunk_index for r in gone.collect()) == [2, 3]
    fresh = index.where("chunk_index < 2").withColumn("text", F.lit("new"))
    assert sorted((r.chunk_index, r.text) for r in incremental.replaced(index, fresh, gone).collect()) == [(0, "new"), (1, "new")]


def test_audit(spark):
    rows = [("a", "x/a.pdf", None, "s"), ("b", "x/b.pdf", b"", "s"), ("c", "x/c.pdf", b"<html>", "s"), ("d", "x/d", b"%PDF-1", "s"), ("e", "x/e.PDF", b"%PDF-1", None), ("f", "x/f.pdf", b"%PDF-1", "s"), ("g", None, None, None)]
    df = spark.createDataFrame(rows, "id string, path string, content binary, sha string")
    got = {r.id: r.a for r in df.select("id", audit.audit_action(F.col("path"), F.col("content"), F.col("sha")).alias("a")).collect()}
    assert got == {"a": audit.CLEAR, "b": audit.CLEAR, "c": audit.DELETE, "d": audit.RENAME + "x/d.pdf", "e": audit.BACKFILL, "f": None, "g": None}
    fixed = {r.id: (r.path, r.sha) for r in audit.repaired(df, "path", "sha", F.col("content")).collect()}
    assert fixed["a"] == (None, None) and fixed["d"][0] == "x/d.pdf" and len(fixed["e"][1]) == 64 and fixed["f"] == ("x/f.pdf", "s")


def test_path_owner(spark):
    df = spark.createDataFrame([("r1", "foo.pdf", None), ("r2", None, "bar.pdf"), ("r3", "foo.pdf", None)], "id string, a string, b string")
    assert {r.path: r.owner_id for r in audit.path_owners(df, "id", ["a", "b"]).collect()} == {"foo.pdf": "r1", "bar.pdf": "r2"}
    ask = lambda i, o: spark.range(1).select(audit.destination(F.lit(i), F.lit("foo.pdf"), F.lit(o).cast("string"))).head()[0]
    assert [ask("r1", "r1"), ask("r2", "r1"), ask("r2", None)] == ["foo.pdf", "r2__foo.pdf", "foo.pdf"]


def test_reconcile_totals_inspect(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "id int"), spark.createDataFrame([(2,), (3,)], "id int")
    assert {r.id: r.status for r in audit.reconciled(a, b, ["id"]).collect()} == {1: "missing_text", 2: "consistent", 3: "orphan_text"}
    site, parsed = spark.createDataFrame([(2010, 5), (2011, None)], "year int, site_total long"), spark.createDataFrame([(2010, 3)], "year int, n long")
    checked = audit.totals_check(site, parsed, "year")
    assert {r.year: (r.gap, r.short) for r in checked.collect()} == {2010: (2, True), 2011: (None, False)}
    assert tuple(audit.gap_sums(checked).head()) == (5, 3, 2)
    got = audit.inspected(spark.createDataFrame([(1,), (9,)], "id int"), a, a.withColumn("s", F.lit("k"))).collect()
    assert {r.id: (r.found, r.s) for r in got} == {1: (True, "k"), 9: (False, None)}


def test_migrate(spark):
    old = spark.createDataFrame([("1", "u1", "C:\\x\\a.pdf"), ("2", "u2", "/y/b.pdf"), ("3", None, None)], "id string, remote_pdf_url string, local_pdf_path string")
    files = spark.createDataFrame([("a.pdf", 3, "sa"), ("b.pdf", 0, "sb")], "name string, length long, sha256 string")
    rows = {r.id: r for r in migrate.migrated(old, files).collect()}
    assert (rows["1"].judgment_pdf_url, rows["1"].judgment_local_pdf_path, rows["1"].outcome) == ("u1", "downloaded_pdfs/a.pdf", "kept")
    assert (rows["2"].judgment_local_pdf_path, rows["2"].outcome, rows["3"].outcome) == (None, "cleared", "no_path")
    assert "remote_pdf_url" not in rows["1"] and rows["1"].schema_version == 2


def test_retrieval(spark):
    index = spark.createDataFrame([("a", "metadata", [1.0, 0.0]), ("b", "judgment_pdf", [1.0, 0.0]), ("c", "sc_judgment_pdf", [0.0, 1.0])], "chunk_id string, chunk_type string, embedding array<float>")
    got = [(r["rank"], r.chunk_id, r.score) for r in retrieval.top_k(index, [1.0, 0.0], 2).orderBy("rank").collect()]
    assert got == [(1, "a", 1.0), (2, "b", 1.0)]
    assert index.where(retrieval.chunk_type_filter("judgment_pdf")).count() == 1 and index.where(retrieval.chunk_type_filter("")).count() == 3
    with pytest.raises(ValueError):
        retrieval.chunk_type_filter("pdf")
    for k in (0, 21):
        with pytest.raises(ValueError):
            retrieval.checked_top_k(k)
    plan = retrieval.top_k(index, [1.0, 0.0], 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_batches_of_questions_agree(spark, monkeypatch):
    v = spark.range(40).select(F.col("id").alias("vec_id"), F.array(F.cos("id"), F.sin("id")).cast("array<float>").alias("embedding"))
    q = v.limit(7).select(F.col("vec_id").alias("question_id"), F.col("embedding").alias("question_embedding"))
    whole = sorted(map(tuple, retrieval.top_k_batch(v, q, 3).collect()))
    monkeypatch.setattr(retrieval, "BROADCAST_QUESTIONS", 2)
    assert sorted(map(tuple, retrieval.top_k_batch(v, q, 3).collect())) == whole and len(whole) == 21


def test_sources_take_snippets_that_were_cut_before_a_join(spark):
    hits = spark.createDataFrame([(1, "r", "judgment_pdf", "u", 0.5, "x" * 280 + "...")], "rank int, record_id string, chunk_type string, source_url string, score double, snippet string")
    assert retrieval.sources(hits).head().snippet == "x" * 280 + "..."


def test_questions_meet_rows_in_matrix_products(spark, monkeypatch):
    """With the same answers as the expressions, to the last bit, for odd vectors and copies too; pairs never become rows of a join."""
    nan, inf, vec = float("nan"), float("inf"), [[(7 * i * j + j) % 11 - 5.0 for j in range(4)] for i in range(60)]
    odd = [None, [], [0.0] * 4, [1.0, None, 2.0, 3.0], [nan, 1.0, 1.0, 1.0], [inf, 1.0, 0.0, 0.0], [1.0, 2.0, 3.0], [1e-30] * 4]
    rows = [(f"k{i}", v, i % 3 if i % 7 else None) for i, v in enumerate(vec + odd + [vec[1]] * 40 + [[x * 3 for x in vec[2]]] * 9)] + [(None, vec[1], 1)]
    index = spark.createDataFrame(rows, "key string, embedding array<double>, label int").repartition(3)
    q = index.selectExpr("key AS question_id", "embedding AS question_embedding", "label AS question_label")
    for same, on in ((None, F.lit(True)), (("label", "question_label"), F.col("label") == F.col("question_label"))):
        want = sorted(map(repr, retrieval.top_k_batch(index, q, 3, "key", on=on).collect()))
        for chunk in (2, 1_000):
            monkeypatch.setattr(retrieval, "BROADCAST_QUESTIONS", 16 * chunk)
            got = retrieval.top_k_batch(index, q, 3, "key", same=same)
            assert sorted(map(repr, got.collect())) == want
        assert "NestedLoop" not in got._jdf.queryExecution().toString()


def test_summary(spark):
    rows = spark.createDataFrame([(2010, "inserted"), (2010, "updated"), (2011, "unchanged")], "year int, outcome string")
    c = summary.yearly_counters(rows, "year", "outcome", ["inserted", "updated", "unchanged"])
    total = summary.run_summary(c.withColumn("failed", F.col("inserted") == 0), "year", "failed").head()
    assert (total.parsed, total.inserted, total.updated, total.unchanged, total.failed) == (3, 1, 1, 1, [2011])


def test_sorted_rank(spark):
    df = spark.range(500).select((F.col("id") * 37 % 101).alias("k"), "id")
    got = [r["rank"] for r in summary.sorted_rank(df, ["k", "id"], 7).orderBy("k", "id").collect()]
    assert got == list(range(1, 501))


def test_ranks_of_many_rows_with_a_payload(spark):
    n = 1_000_000
    df = spark.range(n).select((F.hash("id") % 1000).alias("k"), "id", F.concat(F.lit("payload "), F.col("id").cast("string")).alias("text"))
    got = summary.sorted_rank(df, ["k", "id"], 16)
    row = got.agg(F.count_distinct("rank").alias("n"), F.min("rank").alias("least"), F.max("rank").alias("most")).head()
    assert tuple(row) == (n, 1, n)
    # Ranks follow the order: every row's successor in rank is greater.
    w = Window.partitionBy((F.col("rank") / 1000).cast("int")).orderBy("rank")
    assert got.withColumn("next", F.lead(F.struct("k", "id")).over(w)).where(F.struct("k", "id") > F.col("next")).count() == 0
    assert got.where(F.col("text") != F.concat(F.lit("payload "), F.col("id").cast("string"))).count() == 0


def test_many_blocks_of_questions_are_stored(spark, monkeypatch):
    v = spark.range(40).select(F.col("id").alias("vec_id"), F.array(F.cos("id"), F.sin("id")).cast("array<float>").alias("embedding"))
    q = v.limit(9).select(F.col("vec_id").alias("question_id"), F.col("embedding").alias("question_embedding"))
    whole = sorted(map(tuple, retrieval.top_k_batch(v, q, 3).collect()))
    monkeypatch.setattr(retrieval, "BROADCAST_QUESTIONS", 1)
    monkeypatch.setattr(retrieval, "BLOCKS_A_PLAN", 4)
    assert sorted(map(tuple, retrieval.top_k_batch(v, q, 3).collect())) == whole


def test_ranges_follow_the_hottest_key(spark, monkeypatch):
    feed = spark.range(100).select(F.when(F.col("id") < 70, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    monkeypatch.setattr(upsert, "ROWS_A_RANGE", 20)
    assert upsert.ranges_of(feed, "k") == 4 and upsert.ranges_of(feed.where("false"), "k") == 1


def test_windows_are_counted(spark):
    for n in (0, 1, 320, 321, 700):
        w = F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: i.cast("string"))
        w = F.slice(w, 1, n) if n else F.array().cast("array<string>")
        row = spark.range(1).select(chunking.window_count(w, 380, 60).alias("n"), F.size(chunking.windows(w, 380, 60)).alias("m")).head()
        assert row.n == row.m
