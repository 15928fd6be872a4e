import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import language_id, pii, toxicity
from corpusloom.llm.mixing import mix
from corpusloom.llm.packing import Packer, pack, part_ids
from corpusloom.llm.quality_rules import LineRules, judge, quality_rules, repeat_words

from .helpers import HAS_DATA, LONG, ROWS, SF, documents, words

try:
    import public_tokenizers

    TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
except ImportError:
    TOKENIZER = None
needs_tokenizer = pytest.mark.skipif(TOKENIZER is None, reason="no tokenizer files")
needs_data = pytest.mark.skipif(not HAS_DATA, reason="no test tables here")


# Quality rules


def brute_repeats(w):
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(grams)
    return len({i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(5)})


@given(st.lists(st.sampled_from("abc"), max_size=40))
def test_repeats_match_brute_force(w):
    assert repeat_words(w) == brute_repeats(w)


def test_quality_rows(spark):
    got = quality_rules(documents(spark)).collect()
    assert len(got) == len(ROWS)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert len(by[1]) == 2 and all(r.kept and r.clean_text == ROWS[0][1] for r in by[1])
    assert [(r.n_words, r.base_failed, r.kept) for r in (*by[2], *by[3], *by[5])] == [(0, True, False)] * 3
    assert by[3][0].clean_text is None and by[4][0].base_failed and by[4][0].n_words == len(words(LONG)) == by[4][0].n_repeat_words
    assert quality_rules(documents(spark, [])).count() == 0


@pytest.mark.parametrize(
    "line", ["Home | News | Sport | Contact", "This*** is*** all%%% symbols$$$ here###", "BUY!! NOW!! CHEAP!!", "All rights reserved by us", "Please enable JavaScript to go on"]
)
def test_lines_that_fail(line):
    prose = "\n".join(" ".join(f"word{i}x{j}" for j in range(9)) + "." for i in range(5))
    facts, clean = judge(prose + "\n" + line, LineRules())
    assert clean == prose and facts[6] and facts[7] == 1
    facts, _ = judge("\n".join([line] * 1 + ["one two three"]), LineRules(max_loss=10))
    assert not facts[6]


@pytest.mark.parametrize(
    "line",
    [
        "Home · News · Sport · Contact",
        "Startseite › Produkte › Schuhe › Damen",
        "Home Kontakt Impressum Suche",
        "THIS WHOLE LINE IS A SHOUT AT THE READER",
        " ".join(f"item{i}" for i in range(60)),
        "* * * * *",
        "Alle Rechte vorbehalten.",
        "© 2024 Some Firm",
        "Copyright (c) 2019, the authors",
        "Tous droits réservés",
    ],
)
def test_each_kind_of_rule(line):
    r = LineRules()
    assert r.fails(line, words(line))
    prose = "\n".join(" ".join(f"word{i}x{j}" for j in range(70)) + "." for i in range(3))
    assert judge(f"{prose}\n{line}", r)[1] == prose


@pytest.mark.parametrize(
    "line",
    [
        "HEADLINE IN CAPITALS",
        "The news about the shop: next to it there is a menu, a help desk and a place to register.",
        "« Oui », dit-il, « mais non » !",
        "12.5 13.9 14.2",
        "她说你好。",
        "Licensed under the Apache License, Version 2.0.",
        "NATO and the EU signed a treaty on arms in Geneva.",
        "Contact us",
        "x = a | b",
        "--",
    ],
)
def test_lines_that_pass(line):
    assert not LineRules().fails(line, words(line))


def test_clean_text_is_untouched():
    text = "A first line, with a comma.\n\nWhat? Yes!\n- a list item\n  indented & more\n"
    assert judge(text * 1, LineRules())[1] == text


# Language


def test_language(spark):
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("le chat et le chien", "fr")] * 4)]
    model = language_id.fit(documents(spark, rows))
    assert model.languages == ["de", "en", "fr"]
    got = {r.doc_id: r for r in language_id.predict(documents(spark, [*ROWS[2:], (50, "und die katze", None, None), (51, "12 34!", None, None)]), model).collect()}
    assert got[50].lang_pred == "de" and 0 < got[50].score <= 1
    assert [(got[i].lang_pred, got[i].score) for i in (2, 3, 5, 51)] == [("und", 0.0)] * 4
    assert got[4].lang_pred == "en" and got[8].lang_pred in model.languages
    empty = language_id.fit(documents(spark, []))
    assert empty.languages == [] and {r.lang_pred for r in language_id.predict(documents(spark), empty).collect()} == {"und"}
    assert language_id.predict(documents(spark, []), model).count() == 0


def test_any_number_of_languages(spark, monkeypatch):
    rows = [(i, " ".join(f"{chr(97 + i % 26)}{chr(97 + j)}{chr(97 + (i + j) % 26)}" for j in range(12)), f"l{i % 23:02}", "s") for i in range(230)]
    docs = documents(spark, [*rows, *ROWS], clash=False)
    predicted = lambda: sorted(((r.doc_id, r.lang_pred, round(r.score, 9)) for r in language_id.predict(docs, language_id.fit(docs)).collect()), key=repr)
    whole = predicted()
    monkeypatch.setattr(language_id, "LANGUAGES_A_PASS", 7)
    assert predicted() == whole and len({x[1] for x in whole}) > 15


def test_scores_match_a_plain_sum():
    texts = ["Ab c!", "", "xyz xyz", None, "e"]
    rng = np.random.default_rng(0)
    model = language_id.Model(["p", "q"], np.log([0.4, 0.6]), rng.normal(size=(language_id.BUCKETS, 2)).astype(np.float32))
    names, probs = language_id.score(model, texts)
    for t, name, p in zip(texts, names, probs):
        row, bucket, has = language_id.hashed_rows([t or ""])
        total = model.log_prior + sum((model.log_prob[b].astype(float) for b in bucket), np.zeros(2))
        assert name == (model.languages[int(total.argmax())] if has[0] else "und") and (0.5 <= p <= 1) == bool(has[0])
    assert len(language_id.hashed_rows(["ab"])[0]) == 4 + 3 + 2


@needs_data
def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    got = language_id.predict(docs, language_id.fit(docs.where(~held)), held=held, truth=F.col("lang")).where("held").collect()
    assert np.mean([r.truth == r.lang_pred for r in got]) > 0.95


# Toxicity


@pytest.fixture(scope="module")
def toxic_model(spark):
    bad, good = "idiot moron stupid clown".split(), "table garden window river morning letter".split()
    rows = [(i, " ".join([good[i % 6], good[(i * 5 + 1) % 6], bad[i % 4] if i % 3 == 0 else good[(i + 3) % 6], good[i % 5]]), None, None) for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)] + [(None, 1), (5, None), (9999, 1)], "doc_id long, toxic int")
    return toxicity.fit(documents(spark, rows), labels)


@pytest.mark.parametrize("written", ["idiot", "1d10t", "i.d.i.o.t", "i d i o t", "idiiiiot", "IDIOT!!!", "m0ron", "st*pid", "$tupid", "stuuupid", "c-l-o-w-n", "cl0wn***"])
def test_disguised_words_are_restored(toxic_model, written):
    s = toxicity.Scorer(toxic_model)
    assert s.score(f"the garden {written} by the river") > 0.5 > 0.2 > s.score("the garden wall by the river")


def test_viterbi_matches_all_paths(toxic_model):
    d = toxicity.Decoder(toxic_model.log_p)
    import itertools

    for token in ("1d10t", "m0r0n", "c!0wn", "5tup1d"):
        best = []
        for path in itertools.product(*d.lattice(token)):
            s, state = sum(c for _, c in path), 0
            for ch in "".join(t for t, _ in path):
                c = toxicity.code(ch)
                s += d.log_p[state * 28 + c]
                state = state % 28 * 28 + c
            best.append((s + d.log_p[state * 28], "".join(t for t, _ in path)))
        assert d.decode(token) == max(best)[1]


def test_plain_text_survives_restoring(toxic_model):
    d = toxicity.Decoder(toxic_model.log_p)
    assert d.restore("A letter, a window; 2024 and don't!") == "a letter a window 2024 and don't"
    assert d.restore_token("bob@x.org") == "bob@x.org" and d.restore("") == ""


def test_long_and_joined_tokens_are_restored(toxic_model):
    s = toxicity.Scorer(toxic_model)
    known = s["idiot"]
    assert known > 0
    for joint in "_.-~,;:/":
        assert s[joint.join(["window", "letter", "garden", "river"] * 5 + ["idiot", "street"])] == known, joint
    assert s["letter/idiot"] == known and s["letter,idi0t"] == known
    d = toxicity.Decoder(toxic_model.log_p)
    assert "1" not in d.restore_token("wi1ndow" * 20_000) and d.restore_token("x" * 100_000 + "1") != ""


def test_rare_features_stay_on_larger_tables(spark):
    plain = lambda i: f"table garden w{'abcdefgh'[i % 8]}x river"
    text = lambda i: plain(i) + (" vermin" if i % 800 == 0 else " moron" if i % 8 == 0 else "")
    n = 8_000  # a thousand toxic documents, ten of them with the rare word
    sample = spark.createDataFrame([(text(i), int(i % 8 == 0)) for i in range(n)], "text string, toxic int")
    odds = toxicity._odds(sample)
    assert "vermin" in odds and "moron" in odds and not {"table", "river", "garden"} & set(odds)


@pytest.mark.parametrize("seed", [6, 10, 18])
def test_every_state_is_searched(seed):
    # Under a model of noise, the best path of a token of wild cards is one that twelve others beat at first.
    import itertools

    d = toxicity.Decoder(np.log(np.random.default_rng(seed).dirichlet(np.full(28, 0.1), (28, 28)).clip(1e-9)))

    def cost(path):
        s, state = sum(c for _, c in path), 0
        for ch in "".join(t for t, _ in path):
            c = toxicity.code(ch)
            if c or state % 28:
                s += d.log_p[state * 28 + c]
                state = state % 28 * 28 + c
        return s + (d.log_p[state * 28] if state % 28 else 0.0)

    for token in ("*1*|*b", "*1*1*"):
        assert d.decode(token) == "".join(t for t, _ in max(itertools.product(*d.lattice(token)), key=cost))


def plain_symbols(text):
    """0: not a letter (once in a row), 1-26: a-z without accents, 27: another letter."""
    import unicodedata

    out = [0]
    for ch in text + " ":
        base = unicodedata.normalize("NFD", ch.lower())[0]
        k = (ord(base) - 96 if "a" <= base <= "z" else 27) if ch.isalpha() else 0
        if k or out[-1]:
            out.append(k)
    return out


def brute_model(docs, labels):
    """docs {id: text}, labels {id: 0 or 1} → a score for any text: the model said again with dictionaries. Decoding is the operator's own, which
    other tests hold against all paths."""
    grams = Counter()
    for t in docs.values():
        s = plain_symbols(t)
        grams.update(zip(s, s[1:], s[2:]))

    def probs(counts):
        c = np.zeros((28, 28, 28))
        for g, n in counts.items():
            c[g] = n
        one = (c.sum((0, 1)) + 1) / (c.sum() + 28)
        two = (c.sum(0) + 50 * one) / (c.sum((0, 2))[:, None] + 50)
        return (c + 50 * two) / (c.sum(2, keepdims=True) + 50)

    parts = lambda w: [w, *(f"^{w[:n]}" for n in range(3, 9) if n <= len(w))]
    pos, neg = Counter(), Counter()
    for i, y in labels.items():
        plain = {re.sub(r"^([^\w\s])\1{2,}|([^\w\s])\2{2,}$", "", t.strip(toxicity._EDGE)).strip(toxicity._EDGE).lower() for w in words(docs[i]) for t in re.split(r"[,;:/\\]", w)}
        (pos if y else neg).update({f for w in plain if w and not re.search(r"(\w)\1\1|[0-9@$!|+(€£¡*._~\-]", w) for f in parts(w)})
    n1, n0 = sum(labels.values()), sum(1 - y for y in labels.values())
    odds = {}
    for f, p in pos.items():
        q, n = neg[f], n0 + n1
        ratio = sum(x * np.log(x * n / (r * c)) for x, r, c in ((p, p + q, n1), (q, p + q, n0), (n1 - p, n - p - q, n1), (n0 - q, n - p - q, n0)) if x)
        value = np.log((p + 0.5) / (n1 + 1)) - np.log((q + 0.5) / (n0 + 1))
        if p >= 3 and ratio >= np.log(n) and value >= 2.5:
            odds[f] = value
    whole = [f for f in odds if f[0] != "^"]
    odds = {f: v for f, v in odds.items() if pos[f] >= 1.5 * max((pos[w] for w in whole if f in parts(w)[1:]), default=0)}
    lexicon = Counter()
    s = plain_symbols(" ".join(f.lstrip("^") for f in odds))
    lexicon.update(zip(s, s[1:], s[2:]))
    log_p = np.log(0.6 * probs(grams) + 0.4 * probs({g: 20 * n for g, n in lexicon.items()}))
    decoder = toxicity.Decoder(log_p)
    of = lambda w: max([odds.get(f, 0.0) for f in parts(w)], default=0.0)

    def evidence(text):
        hits = [max(map(of, decoder.restore_token(t).split()), default=0.0) for t in words(text)] + [of(w) for w in decoder.spaced(text)]
        total = sum(hits)
        return [max(hits), np.log1p(total), np.log1p(100 * total / len(words(text)))] if total else [0.0] * 3

    x, y = np.array([[1.0, *evidence(docs[i])] for i in labels]), np.array([*labels.values()], float)
    w = np.zeros(4)
    for _ in range(200):  # Newton's method on the penalised likelihood
        p = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 0.1 * np.eye(4), x.T @ (y - p) - 0.1 * w)
    return odds, lambda text: 1 / (1 + np.exp(-np.dot(w, [1.0, *evidence(text or "")])))


def test_scores_match_brute_force(spark):
    import random

    rng = random.Random(4)
    bad, good = "idiot moron stupid clown vermin".split(), ["".join(rng.choices("abcdeilmnorstu", k=rng.randrange(2, 9))) for _ in range(200)]
    noisy = lambda w: rng.choice([w, w, w, w.replace("i", "1").replace("o", "0"), ".".join(w), " ".join(w), w.upper() + "!!!", w + "/" + rng.choice(good)])
    docs = {}
    for i in range(300):
        t = rng.choices(good, k=rng.randrange(3, 25))
        for _ in range(rng.randrange(1, 3) if i % 4 == 0 else 0):
            t.insert(rng.randrange(len(t)), noisy(rng.choice(bad)))
        docs[i] = " ".join(t)
    labels = {i: int(i % 4 == 0) for i in docs if i % 3}
    odds, score = brute_model(docs, labels)
    frame = documents(spark, [(i, t, None, None) for i, t in docs.items()])
    model = toxicity.fit(frame, spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"))
    assert model.odds.keys() == odds.keys() and odds and all(abs(model.odds[f] - v) < 1e-9 for f, v in odds.items())
    got = {r.doc_id: r.score for r in toxicity.predict(frame, model).collect()}
    assert all(abs(got[i] - score(t)) < 1e-6 for i, t in docs.items())


LARGER = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test tables here")
def test_toxicity_held_out(spark):
    from corpusloom.llm.queries import op2_toxicity

    truth = spark.read.parquet(f"{LARGER}/labels.parquet").select("doc_id", "toxic")
    rows = op2_toxicity(spark, LARGER).where("held_out").join(truth, "doc_id").select("score", "predicted", "toxic").collect()
    found = sum(r.predicted and r.toxic for r in rows)
    assert found >= 0.9 * sum(r.toxic for r in rows) and found >= 0.95 * sum(r.predicted for r in rows)
    pos, neg = ([r.score for r in rows if r.toxic == k] for k in (1, 0))
    assert np.mean([(a > b) + (a == b) / 2 for a in pos for b in neg]) > 0.95


def test_toxic_rows(spark, toxic_model):
    got = {r.doc_id: r for r in toxicity.predict(documents(spark), toxic_model, restored=True).collect()}
    assert len(got) == 9 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert got[2].score == got[3].score == got[5].score and got[3].restored_text == ""
    assert toxicity.predict(documents(spark, []), toxic_model).count() == 0
    none = toxicity.fit(documents(spark, []), spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r.score < 0.01 and not r.predicted for r in toxicity.predict(documents(spark), none).collect())
    one = spark.createDataFrame([(i, 1) for i in (1, 2, 3)], "doc_id long, toxic int")
    assert all(r.score > 0.7 for r in toxicity.predict(documents(spark), toxicity.fit(documents(spark), one)).collect())


# Mixing


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        left, ow = total - sum(target.values()), sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / ow > most * sizes[s]]
        if not over:
            return target | {s: left * w[s] / ow for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            open_.remove(s)
    return target


@pytest.mark.parametrize("seed", range(3))
def test_mix_matches_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    n = 400
    rows = [(int(i), "w " * int(rng.integers(0, 30) if i % 50 else 900), "en", [None, "b", "a", "\U0001f600", "￿", "tiny"][int(rng.choice(6, p=[0.1, 0.35, 0.2, 0.2, 0.1, 0.05]))]) for i in range(n)]
    got = mix(documents(spark, rows)).collect()
    sizes, of = Counter(), {r[0]: r for r in rows}
    for i, t, _, s in rows:
        sizes[s] += len(words(t))
    want = brute_targets(sizes)
    taken = Counter()
    for r in got:
        s = of[r.doc_id][3]
        assert r.size == len(words(of[r.doc_id][1])) and r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 2 for s in sizes)
    # Thresholds nest: whatever a smaller budget takes, a larger one takes too.
    less = {r.doc_id: r.taken for r in mix(documents(spark, rows), share=1.2).collect()}
    assert sum(less.values()) < sum(taken.values())
    again = mix(documents(spark, rows).repartition(3)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_mix_edges(spark):
    got = mix(documents(spark)).collect()
    assert len(got) == len(ROWS) and all(r.taken <= 2 * r.size for r in got)
    assert mix(documents(spark, [])).count() == 0
    assert {(r.target, r.taken) for r in mix(documents(spark, [(1, "", "x", "s"), (2, None, None, None)])).collect()} == {(0.0, 0)}
    # A group of rows with one id splits the budget at its hash.
    same = mix(documents(spark, [(None, "a b c d e f", "x", "s")] * 100 + [(1, "q " * 5, "x", "t")])).collect()
    for size in (600, 5):
        rows = [r for r in same if r.source_size == size]
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= len(rows)
    plan = mix(documents(spark), carry=("text",))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# Packing


@settings(deadline=None)
@given(st.lists(st.integers(1, 70), max_size=60))
def test_packer_places_every_id_once(lengths):
    capacity, p = 32, Packer(32, 7)
    docs = [np.arange(i * 1000, i * 1000 + n, dtype="<u4").tobytes() for i, n in enumerate(lengths)]
    for i, ids in enumerate(docs):
        p.add(i, ids)
    p.finish()
    length, covered = Counter(), defaultdict(list)
    for doc, start, n, crc, total, seq, offset in p.out:
        assert n > 0 and offset == length[seq] and total == lengths[doc] and crc == zlib.crc32(docs[doc][4 * start : 4 * (start + n)])
        length[seq] += n
        covered[doc] += range(start, start + n)
    assert all(sorted(covered[i]) == list(range(n)) for i, n in enumerate(lengths))
    assert all(n <= capacity and n & (n - 1) == 0 for n in length.values())


def test_class_bins_hold_a_fixed_count():
    p = Packer(100 + 28, 0)
    for i in range(12):
        p.add(i, b"\0\0\0\0" * 32)  # exactly a quarter
    assert sorted(Counter(x[5] for x in p.out).values()) == [4, 4, 4]


@needs_tokenizer
def test_pack_rows(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    rows = pack(documents(spark), TOKENIZER).collect()
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append(r)
    for i, text, *_ in ROWS:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert {r.doc_tokens for r in got[i]} == {len(ids)}
        assert sum(r.length for r in got[i]) == len(ids) * (2 if i == 1 else 1)
        for r in got[i]:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    length = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == length[r.sequence_id]
        length[r.sequence_id] += r.length
    assert all(n <= 4096 and n & (n - 1) == 0 for n in length.values())
    assert pack(documents(spark, []), TOKENIZER).count() == 0


@needs_tokenizer
@settings(deadline=None, max_examples=1000)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t\r'sdlmtrve|<>̀ßéİΣŉ.,12!endoftext")), max_size=40))
def test_ids_equal_the_tokenizers(text):
    w = part_ids(TOKENIZER)
    assert w.encode(text) == np.array(w.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@needs_tokenizer
def test_another_tokenizer_file_is_left_to_the_tokenizer(tmp_path):
    import json

    from tokenizers import Tokenizer

    settings = json.load(open(TOKENIZER))
    settings["normalizer"]["normalizers"].pop()  # case matters now
    (tmp_path / "t.json").write_text(json.dumps(settings))
    for text in ("Hello World, it's 12", "plain words", "ÀÉ x"):
        ids = Tokenizer.from_file(str(tmp_path / "t.json")).encode(text, add_special_tokens=False).ids
        assert part_ids(str(tmp_path / "t.json")).encode(text) == np.array(ids, "<u4").tobytes()
    assert part_ids(TOKENIZER).known and not part_ids(str(tmp_path / "t.json")).known


# PII

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    def ok(kind, s):
        d = [int(c) for c in s if c in "0123456789"]
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            return 16 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0
        return kind == "email" or 8 <= len(d) <= 15

    return [[m.span() for m in re.finditer(p, text) if ok(k, m[0])] for k, p in PATTERNS.items()]


@settings(max_examples=500)
@given(st.text(st.sampled_from("0123456789@@..-- +()a%x\n"), max_size=60))
def test_base_spans_match_the_patterns(text):
    assert pii.base_spans(text) == brute_spans(text)


def test_pii_rows(spark):
    got = {r.doc_id: r for r in pii.find(documents(spark), clean=True).collect()}
    r = got[6]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    assert r.clean_text == "mail [EMAIL] or [PHONE] now, card [CARD], host [IP]!"
    base = pii.joined(pii.base_spans(ROWS[7][1]))
    assert r.spans.startswith(base) and r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert got[3].spans == "" and got[3].base_sha256 == hashlib.sha256(b"").hexdigest() and got[3].clean_text == ""
    assert got[4].clean_text == LONG and pii.find(documents(spark, [])).count() == 0


def disclosing(spark):
    other = "alpha beta gamma delta epsilon zeta eta theta".split()
    rows = [(i, f"{w}{i} zanzibar told bob@x.org that {other[-1 - i]} {w} is late {i}", None, None) for i, w in enumerate(other)]
    rows += [(100 + i, f"we told them that {other[i % 8]} is late, number {i} is on time", None, None) for i in range(40)]
    rows += [(200 + i, "a rare copy of carol@y.org secretword stays here", None, None) for i in range(30)]
    return documents(spark, [*rows, (300, "only (Zanzibar) here", None, None)])


@pytest.mark.parametrize("a_pass", [pii.TERMS_A_PASS, 1])
def test_terms_that_give_an_entity_away(spark, monkeypatch, a_pass):
    monkeypatch.setattr(pii, "TERMS_A_PASS", a_pass)
    docs = disclosing(spark)
    terms = {r.term for r in pii.disclosing_terms(docs).collect()}
    assert "zanzibar" in terms and not terms & {"told", "late", "secretword", "copy"}
    got = {r.doc_id: r for r in pii.find(docs, clean=True).collect()}
    assert got[300].spans == "term:6:14" and got[300].clean_text == "only () here" and got[300].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[0].spans.startswith("email:21:30,term:7:15") and got[200].n_term == 0


def test_copies_count_once_and_terms_may_stand_together(spark):
    import random

    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(2000)]
    some = lambda n: " ".join(rng.choices(words, k=n))
    # Ten contexts and very many copies of one; a first and a last name that always stand by an address, in a fixed phrase.
    passage = f"{some(30)} zanzibar wrote bob@x.org about it {some(30)}"
    texts = [f"{some(30)} zanzibar {some(2)} bob@x.org {some(30)}" for _ in range(10)] + [passage] * 300
    texts += [f"{some(30)} please do ask hrothgar wulfstan <ann@y.org> if you need more help {some(30)}" for _ in range(10)]
    # Copies with an edited word each are copies.
    for i in range(300):
        copy = f"{passage} {some(20)}".replace("zanzibar", "secretword").replace("bob@", "eve@").split() if not i else copy
        edited = [*copy]
        edited[rng.choice([*range(20), *range(45, 60)])] = rng.choice(words)
        texts.append(" ".join(edited))
    texts += [some(60) for _ in range(400)]
    terms = {r.term for r in pii.disclosing_terms(documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])).collect()}
    assert terms >= {"zanzibar", "hrothgar", "wulfstan"} and "secretword" not in terms


@needs_tokenizer
def test_ids_of_every_plain_character():
    w = part_ids(TOKENIZER)
    for c in [*map(chr, range(0x250)), "\u0307", "\ufb01", "\u1e9e", "\u2028"]:
        for text in (c, f"a{c}b", f"1{c}'s {c.upper()}{c}!", f"{c}{c}"):
            assert w.encode(text) == np.array(w.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), hex(ord(c))


def brute_contexts(text, rules):
    """(entity, term, hashes of the context) of a text, said again over word positions."""
    text, edge = text or "", pii._EDGE
    places = [m.span() for m in re.finditer("[^\x20\x09-\x0d]+", text)]
    for own in brute_spans(text):
        for a, b in own:
            before = [text[s:e] for s, e in places if e <= a][-65:]
            after = [text[s:e] for s, e in places if s >= b][:65]
            core = lambda ws: [w.strip(edge).lower() for w in ws]
            n = rules.window
            near = sorted(set(core(before[len(before) - min(n, len(before)) :] + after[:n])))
            far = [core(before[: max(0, len(before) - n)]), core(after[n:])]
            units = {f"{x} {y}" for side in far for x, y in zip(side, side[1:])} or {x for side in far for x in side}
            for term in near:
                if len(term) >= rules.min_chars and not re.search("[0-9]", term) and "@" not in term:
                    yield text[a:b].lower(), term, *pii.least_hashes(units or [t for t in near if t != term])


def test_context_is_counted_in_words_of_any_length():
    text = f"Johnson {'z' * 450} (bob@x.org), {'y' * 500} Smith"
    (entity, near, far), = pii.surroundings(text, pii.Disclosure())
    assert entity == "bob@x.org" and near == sorted(["johnson", "z" * 450, "y" * 500, "smith"]) and far == [[], []]
    (_, near, far), = pii.surroundings(" ".join(f"w{i}" for i in range(100)) + " a@b.cc " + " ".join(f"v{i}" for i in range(100)), pii.Disclosure())
    assert len(near) == 10 and far == [[f"w{i}" for i in range(35, 95)], [f"v{i}" for i in range(5, 65)]]


def brute_terms(texts, rules=pii.Disclosure()):
    rows = Counter(x for t in texts for x in brute_contexts(t, rules))
    for _ in range(4):  # contexts that agree in one hash are one, with the later hashes that most have
        groups = defaultdict(Counter)
        for row, n in rows.items():
            groups[row[:2], row[2]][row[3:]] += n
        rows = Counter()
        for ((entity, term), _), later in groups.items():
            most = max((n, h) for h, n in later.items())[1]
            rows[entity, term, *most] += sum(later.values())
    pairs = Counter((entity, term) for entity, term, _ in rows)
    n_beside, good = Counter(), {p: n for p, n in pairs.items() if n >= rules.min_contexts}
    for (_, term), n in pairs.items():
        n_beside[term] += n
    elsewhere = Counter()
    for t in texts:
        beside = {x[1] for x in brute_contexts(t, rules)}
        elsewhere.update({w.strip(pii._EDGE).lower() for w in words(t)} - beside)
    out = set()
    for (entity, term), n in good.items():
        n_entity = max(m for (e, _), m in good.items() if e == entity)
        share = np.log(n * len(texts) / (n_entity * (n_beside[term] + elsewhere[term]))) / np.log(max(len(texts), n_entity + 1) / n_entity)
        if share >= rules.threshold:
            out.add(term)
    return out


def corpus_with_secrets(seed, n=300):
    import random

    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(300)]
    some = lambda k: " ".join(rng.choices(vocabulary, k=k))
    entities = ["bob@x.org", "eve@y.org", "10.0.0.7", "+1 (555) 010-2030"]
    names = {e: [f"name{chr(97 + i)}x", f"other{chr(97 + i)}x"] for i, e in enumerate(entities)}
    passages = [f"{some(20)} {entities[0]} copied {some(30)}" for _ in range(3)]
    texts = []
    for i in range(n):
        e = rng.choice(entities)
        texts.append(rng.choice([
            some(rng.randrange(1, 90)), rng.choice(passages), f"{some(rng.randrange(0, 99))} {rng.choice(names[e])}, {e}! {some(rng.randrange(0, 99))}",
            f"{some(5)} {rng.choice(names[e])} {some(3)}", f"{e}", f"see {e} and {rng.choice(entities)} {some(60)}", "",
        ]))
    return [*texts, None, "q" * 500 + " bob@x.org " + "r" * 500]


@pytest.mark.parametrize("seed", range(3))
def test_disclosing_terms_match_brute_force(spark, seed):
    texts = corpus_with_secrets(seed)
    docs = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    got = {r.term for r in pii.disclosing_terms(docs).collect()}
    want = brute_terms(texts)
    assert got == want and want
    spans = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    for i, t in enumerate(texts):
        own = [(m.start() + m[0].index(m[0].strip(pii._EDGE)), len(m[0].strip(pii._EDGE))) for m in re.finditer("[^\x20\x09-\x0d]+", t or "") if m[0].strip(pii._EDGE).lower() in want]
        assert spans[i] == pii.joined([*brute_spans(t or ""), [(a, a + n) for a, n in own]])
