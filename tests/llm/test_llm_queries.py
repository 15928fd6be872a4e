"""The registered queries against their SQL, and the pipeline against a plain version of itself."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import pii, queries
from corpusloom.llm.pii import cleaned
from corpusloom.llm.quality_rules import LineRules, judge
from corpusloom.llm.sql import ORACLE_SQL

from .helpers import CLASHES, HAS_DATA, SF, words
from .test_set_operators import brute_join
from .test_text_operators import brute_model, brute_spans, brute_targets, brute_terms

pytestmark = pytest.mark.skipif(not HAS_DATA, reason="no test tables here")
COLUMNS = {
    "op1": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op2": "doc_id held_out score predicted",
    "op3": "doc_id held_out lang_pred score",
    "op4": "doc_id n_shingles component_id",
    "op5": "doc_id size source_size target taken",
    "op6": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op7": "vec_id n_links component_id kept",
    "op8": "page_id url text n_chars",
    "op9": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op10": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op11": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op12": "word form root n n_near form_n",
    "op13": "vec_id code error label_error codebooks_sha256",
}


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n != "pipeline"])
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(df.columns)
    got = df.collect()
    assert got
    if name in ORACLE_SQL:
        c = duckdb.connect()
        for t in ("documents", "conversations", "embeddings"):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        rel, cols = c.sql(ORACLE_SQL[name]), sorted(df.columns)
        assert sorted(rel.columns) == cols
        at = [rel.columns.index(k) for k in cols]
        assert sorted(repr(tuple(r[k] for k in cols)) for r in got) == sorted(repr(tuple(r[i] for i in at)) for r in rel.fetchall())


def test_held_out_rows(spark):
    for q, m, k in ((queries.op2_toxicity, 4, 2), (queries.op3_language_id, 3, 1)):
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % m == k) for r in q(spark, SF).collect())


def test_packing_of_the_table(spark):
    """Every document's ids, made by the tokenizer itself, are what its pieces hold; sequences are gapless and hardly padded."""
    import struct

    import tokenizers

    tokenizer = tokenizers.Tokenizer.from_file(queries.tokenizer_file())
    ids = {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    upto, fill = Counter(), defaultdict(list)
    for r in sorted(queries.op6_packing(spark, SF).collect(), key=lambda r: (r.doc_id, r.start)):
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert r.start == upto[r.doc_id] and r.length == len(own) > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(own)}I", *own))
        upto[r.doc_id] += r.length
        fill[r.sequence_id].append((r.offset, r.length))
    assert upto == {d: len(x) for d, x in ids.items()}
    used = held = 0
    for own in fill.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
        used, held = used + at, held + (at if at & (at - 1) == 0 else 4096)
    assert used >= 0.95 * held


def test_hostile_conversation(spark):
    import hashlib

    r = [r for r in queries.op9_chat_format(spark, SF).collect() if r.conv_id == -7][0]
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (2, len(queries.HOSTILE), hashlib.sha256(queries.HOSTILE.encode()).hexdigest())


def term_spans(text, terms):
    """Where words are terms, without the signs at their edges."""
    core = [(m.start() + m[0].index(x), x) for m in re.finditer("[^\x20\x09-\x0d]+", text or "") if (x := m[0].strip(pii._EDGE))]
    return [(a, a + len(x)) for a, x in core if x.lower() in terms]


def test_pii_of_the_tables(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    terms = brute_terms(list(texts.values()))
    for r in queries.op10_pii(spark, SF).collect():
        base = brute_spans(texts[r.doc_id] or "")
        assert r.spans == pii.joined([*base, term_spans(texts[r.doc_id], terms)]) and [r.n_email, r.n_ip, r.n_card, r.n_phone] == [*map(len, base)]
        assert r.n_spans == r.n_term + sum(map(len, base))


def test_toxicity_of_the_tables(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    _, score = brute_model(texts, labels)
    for r in queries.op2_toxicity(spark, SF).collect():
        assert abs(r.score - score(texts[r.doc_id])) < 1e-6 and r.predicted == (r.score >= 0.3)


def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline as p

    assert [n for n, _ in p.STAGES][0] == "quality rules" and len(p.STAGES) == 5 and p.ORACLE_SQL is None
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = [f for _, f in p.STAGES]

    def rows(df):
        assert df.columns == list(p.COLUMNS)
        return sorted(map(tuple, df.collect()), key=repr)

    good = stage[0](spark, docs, SF).cache()
    want = []
    for r in docs.collect():
        facts, text = judge(r.text, LineRules())
        if facts[6]:
            want.append((r.doc_id, text, r.lang, r.source, len(text)))
    assert rows(good) == sorted(want, key=repr)
    single = stage[1](spark, good, SF).cache()
    keep = {a for a, _, c in brute_join(want) if a == c}
    assert rows(single) == sorted((r for r in want if repr(r[0]) in keep), key=repr)
    safe = stage[2](spark, single, SF).cache()
    got = {r.doc_id: r.text for r in safe.collect()}
    assert len(got) == single.count()
    terms = brute_terms([r.text for r in single.collect()])
    for r in single.collect():
        assert got[r.doc_id] == cleaned(r.text, [*brute_spans(r.text), term_spans(r.text, terms)])
    assert any("[EMAIL]" in t for t in got.values())
    mixed = stage[3](spark, safe, SF).cache()
    rows(mixed)
    sizes, taken = Counter(), Counter()
    for r in safe.collect():
        sizes[r.source] += len(words(r.text))
    for r in mixed.collect():
        taken[r.source] += len(words(r.text))
        assert got[r.doc_id].startswith(r.text)
    target = brute_targets(sizes)
    assert all(abs(taken[s] - target[s]) <= 2 for s in sizes)
    packed = stage[4](spark, mixed, SF).collect()
    length, tokens = Counter(), defaultdict(int)
    for r in packed:
        length[r.sequence_id] += r.length
        tokens[r.doc_id] += r.length
    assert all(n <= 4096 and n & (n - 1) == 0 for n in length.values())
    assert set(tokens) == {r.doc_id for r in mixed.select("doc_id").distinct().collect()} and np.sum(list(tokens.values())) == sum(length.values())


def test_stages_on_odd_rows(spark):
    import corpus_pipeline as p

    long = " ".join(f"w{i}" for i in range(40))
    near = long.replace("w39", "other")
    lone = " ".join(f"v{i}" for i in range(40))
    rows = [(7, long), (7, long), (7, near), (7, lone), (9, lone), (None, long), (None, "z " + lone.replace("v", "u")), (None, "z " + lone.replace("v", "u")), (3, None), (3, None), (4, " \n"), (5, "")]
    df = spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    odd = df.withColumns({c: F.lit("clash") for c in CLASHES if c != "n_chars"})
    stage = dict(p.STAGES)
    got = Counter((r.doc_id, r.text) for r in stage["n-gram Jaccard join"](spark, odd, SF).collect())
    # One of the two texts with the id 7 that are near copies, the other text with that id, one without an id, and all rows without a word.
    assert got.total() == 7 and sum(n for (i, t), n in got.items() if i == 7 and t in (long, near)) == 1
    assert got[7, lone] == 1 and got[None, "z " + lone.replace("v", "u")] == 1 and (got[3, None], got[4, " \n"], got[5, ""]) == (2, 1, 1)
    assert {r.doc_id for r in stage["quality rules"](spark, odd, SF).collect()} == {7, 9, None}
    assert sorted((r.doc_id or 0, r.text) for r in stage["PII"](spark, odd, SF).collect()) == sorted((i or 0, t or "") for i, t in rows)
    mixed = stage["mixing"](spark, odd, SF).collect()
    assert mixed and all(r.text and r.text.strip() for r in mixed)
    packed = stage["packing"](spark, odd, SF).collect()
    assert sum(r.length == 1 == r.doc_tokens for r in packed) == 4 and {r.doc_id for r in packed} == {i for i, _ in rows}
    for name, f in p.STAGES:
        assert f(spark, odd.where("false"), SF).count() == 0, name
