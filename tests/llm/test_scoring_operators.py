"""Class-based language model, spelling variants and vector codes against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import class_lm, spelling, vector_codes

from .helpers import CLASHES, HAS_DATA, ROWS, SF, documents, words

# Spelling variants


def low(run):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)


def brute_words(texts, every=97):
    n = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = low(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def differ_by_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(n):
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and v != w and differ_by_one(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def variants(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_spelling_against_brute_force(spark):
    base = ["there", "these", "then", "aabbb", "aaabbb", "straße", "strasse", "élève", "eleve", "naïve", "a÷b×c", "wordless", "WORDLESS"]
    rows = [(k, " ".join(base[(k * 7 + i) % len(base)] + "xyz"[: (k + i) % 3] for i in range(12)), "en", "a") for k in range(60)]
    rows += [(None, "there there there" + " abcdef" * 20 + " abcdeg" * 8 + " abcdhg" * 3, None, None), *ROWS, *[(k, "q" * 3000 + " " + "q" * 2999, "en", "a") for k in range(900, 904)]]
    got = variants(spelling.spelling_variants(documents(spark, rows)))
    assert got == brute_variants(brute_words([(r[0], r[1]) for r in rows]))
    assert any(r[2] != (r[1] or r[0]) for r in got) and any(len(r[0]) == 3000 and r[4] for r in got)


def test_spelling_of_nothing(spark):
    for rows in ([], [(1, None, None, None), (2, "", "en", "a"), (3, "one two a b c", "en", "a")]):
        assert spelling.spelling_variants(documents(spark, rows)).collect() == []


def test_deletion_keys_stand_for_strings():
    names = ["aabbb", "abbb", "aabb", "aabbc", "straße", "x" * 50]
    strings = defaultdict(set)
    count = Counter()
    for number, kind, at, key in spelling.deletion_keys(names):
        for w, k, i, x in zip(number, kind, at, key):
            word = names[w]
            strings[int(x)].add((word if k == spelling.WHOLE else word[:i] + word[i + 1 :], i if k == spelling.REPLACED else None))
            count[word, int(k)] += 1
    assert all(len(s) == 1 for s in strings.values()) and len({next(iter(s)) for s in strings.values()}) == len(strings)
    assert all(count[w, spelling.REPLACED] == len(w) and count[w, spelling.WHOLE] == 1 and count[w, spelling.DELETED] == len(re.findall(r"(.)\1*", w)) for w in names)


def test_colliding_keys_join_nothing():
    D, W, R = spelling.DELETED, spelling.WHOLE, spelling.REPLACED
    rows = [("there", 9, R, 4), ("these", 5, R, 4), ("thera", 4, R, 4), ("thers", 7, R, 4), ("thers", 7, D, 4), ("other", 2, W, -1), ("ther", 3, W, -1)]
    assert sorted(spelling._partners(rows)) == [("ther", 1, 7, "thers"), ("thera", 2, 9, "there"), ("there", 2, 7, "thers"), ("thers", 1, 3, "ther"), ("thers", 2, 9, "there")]


def test_chains_of_forms_lead_to_their_ends(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(20)] + [("v", "w3")]
    assert {tuple(r) for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()} == {(w, "w20") for w, _ in chain}


# Vector codes


def brute_codes(rows, parts=8, entries=16, rounds=6):
    """rows: (id, vector, label), all kept and of one length."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(rows[0][1]) // parts
    cells = [[[math.floor(4096 * x) for x in v[p * w : (p + 1) * w]] for p in range(parts)] for _, v, _ in rows]
    book = [[list(c[p]) for c in cells[:entries]] for p in range(parts)]

    def nearest(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for c in cells:
                own[nearest(c[p], p)[1]].append(c[p])
            for k, xs in own.items():
                book[p][k] = [sum(col) // len(xs) for col in zip(*xs)]
    sha = hashlib.sha256(",".join(str(x) for b in book for e in b for x in e).encode()).hexdigest()
    found = [[nearest(c[p], p) for p in range(parts)] for c in cells]
    error = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for r, e in zip(rows, error):
        by_label[r[2]] += e
    return sorted(((r[0], "".join(f"{k:02x}" for _, k in f), e, by_label[r[2]], sha) for r, f, e in zip(rows, found, error)), key=repr)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit("clash") for c in ("code", "error", "id", "n", "data", "v")})


def odd_vectors():
    rng = np.random.default_rng(5)
    rows = [(k, [float(np.float32(x)) for x in rng.normal(0, 1, 16)], k % 3 or None) for k in range(60)]
    rows += [rows[3], rows[3], (7, [-1.0] * 16, 2), (None, [0.5] * 16, None), (None, [0.25] * 16, 1)]
    bad = [(100, None, 1), (101, [None] + [0.0] * 15, 1), (102, [float("nan")] * 16, 1), (103, [float("inf")] * 16, None)]
    return rows, bad


@pytest.mark.parametrize("most", [10_000, 0])
def test_codes_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", most)
    monkeypatch.setattr(vector_codes, "BLOCK", 16 * 7)
    rows, bad = odd_vectors()
    got = vector_codes.compress(vectors(spark, rows + bad).repartition(5))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_codes(rows)


def test_codes_of_few_or_no_vectors(spark):
    rows, bad = odd_vectors()
    assert sorted(map(tuple, vector_codes.compress(vectors(spark, rows[:5])).collect()), key=repr) == brute_codes(rows[:5])
    assert vector_codes.compress(vectors(spark, bad)).collect() == [] and vector_codes.compress(vectors(spark, rows).where("false")).collect() == []


def test_codes_of_uneven_vectors(spark):
    """Shorter vectors are followed by zeros; components too large to be exact are an error."""
    rows = [(1, [1.0, 2.0, 3.0], 1), (2, [0.5] * 9, 1), (3, [], None)]
    full = [(k, v + [0.0] * (16 - len(v)), x) for k, v, x in rows]
    assert sorted(map(tuple, vector_codes.compress(vectors(spark, rows)).collect()), key=repr) == brute_codes(full)
    with pytest.raises(Exception, match="compared exactly"):
        vector_codes.compress(vectors(spark, [(1, [1e30] * 8, 1)])).collect()


# Class-based language model


def brute_tokens(text):
    return [low(w) for w in words(text)] + ["\n"]


def brute_base(rows, held):
    counts = Counter(t for r in rows if not held(r) for t in brute_tokens(r[1]))
    n, v = counts.total(), len(counts)
    out = []
    for r in rows:
        own = brute_tokens(r[1])
        out.append((r[0], len(own), sum(counts[t] > 0 for t in own), n, sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)))
    return out, counts


def brute_score(rows, train, counts, model):
    """By the classes of the model alone: transitions and emissions are counted anew."""
    shapes_from, n_classes = model.shapes_from, len(model.transition)
    end = n_classes - 1

    def class_of(t):
        if t == "\n":
            return end
        k = model.index.get(t.encode("utf-8", "surrogatepass"))
        node = shapes_from + class_lm.shape(t.encode("utf-8", "surrogatepass")) if k is None else model.node[k]
        return int(model.class_of[node])

    pairs, size, members = Counter(), Counter(), Counter()
    for _, text, *_ in train:
        own = [end, *map(class_of, brute_tokens(text))]
        pairs.update(zip(own, own[1:]))
        size.update(own[1:])
    members.update(class_of(t) for t in counts)
    for k in range(n_classes - 1 - len(class_lm.SHAPES), end):
        members[k] += 1
    followers = Counter(a for a, _ in pairs)
    total = sum(size.values())

    def log_p(a, b):
        t, prior = max(followers[a], 1), (size[b] + 0.5) / (total + 0.5 * n_classes)
        return math.log10((pairs[a, b] + t * prior) / (size[a] + t))

    def emission(t):
        c = class_of(t)
        return 0.0 if c == end else math.log10((counts[t] + 0.5) / (size[c] + 0.5 * members[c]))

    out = []
    for _, text, *_ in rows:
        own = brute_tokens(text)
        cls = [end, *map(class_of, own)]
        out.append(sum(log_p(a, b) for a, b in zip(cls, cls[1:])) + sum(map(emission, own)))
    by_class = Counter()
    for t in counts:
        if t != "\n":
            by_class[class_of(t)] += 10 ** emission(t)
    return out, by_class, members


@pytest.mark.parametrize("head", [class_lm.HEAD, 5])
def test_scores_against_brute_force(spark, head):
    some = [(k, " ".join(w for i in range(30) for w in (("the", "a")[(k + i) % 2], ("cat", "dog", "42", "née", "end.")[(k * i) % 5], ("sat", "ran")[i % 2])), "en", "a") for k in range(10, 40)]
    rows = [*some, *ROWS, (50, "unseen Words only", "en", "a")]
    held = lambda r: r[0] == 50
    df = documents(spark, rows)
    held_out = F.coalesce(F.col("doc_id") == 50, F.lit(False))
    model = class_lm.fit(df.where(~held_out), class_lm.Rules(classes=4, min_count=2), head=head)
    got = class_lm.score(df, model, held_out=held_out)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    base, counts = brute_base(rows, held)
    score, by_class, members = brute_score(rows, [r for r in rows if not held(r)], counts, model)
    want = sorted((r[0] is None, r[0] or 0, *b[1:], s) for r, b, s in zip(rows, base, score))
    have = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got.collect())
    assert len(want) == len(have)
    for a, b in zip(want, have):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)
    assert all(p == pytest.approx(1) if c < 4 else p < 1 for c, p in by_class.items())  # a class's words, and in a shape's class one unknown word more


def test_model_of_nothing(spark):
    df = documents(spark, [(1, "some words", "en", "a"), (2, None, "en", "a")])
    model = class_lm.fit(df.where("false"))
    for r in class_lm.score(df, model).collect():
        assert r.train_tokens == r.n_known == 0 and r.n_tokens == (3 if r.doc_id == 1 else 1) and r.base_score == pytest.approx(0) and math.isfinite(r.score)
    assert class_lm.score(df.where("false"), model).collect() == []


def test_exchange_gains_are_exact():
    """Each move of a block raises the likelihood, counted anew, when no other block moves."""
    rng = np.random.default_rng(3)
    words_, classes = 12, 3
    nodes, total = words_ + len(class_lm.SHAPES) + 1, classes + len(class_lm.SHAPES) + 1
    seq = np.concatenate([[nodes - 1], rng.integers(0, nodes - 1, 4000) // (1 + np.arange(4000) % 2), [nodes - 1]])
    pairs = Counter(zip(seq.tolist(), seq[1:].tolist()))
    keys = Counter()
    for (a, b), n in pairs.items():
        keys[(2 * a) * nodes + b] += n
        keys[(2 * b + 1) * nodes + a] += n
    at = np.array(sorted(keys))
    n = np.array([keys[k] for k in at.tolist()])
    class_of = np.concatenate((np.arange(words_) % classes, np.arange(classes, total)))

    def matrix(class_of):
        got = np.zeros((total, total))
        for (a, b), m in pairs.items():
            got[class_of[a], class_of[b]] += m
        return got

    moves = class_lm.exchanged(at, n, nodes, class_of, matrix(class_of), classes, None)
    assert moves
    now = class_lm.likelihood(matrix(class_of))
    for w, c in moves.items():  # in their order
        every = []
        for k in range(classes):
            tried = class_of.copy()
            tried[w] = k
            every.append(class_lm.likelihood(matrix(tried)))
        assert c == int(np.argmax(every)) and every[c] > now
        class_of, now = class_of.copy(), every[c]
        class_of[w] = c


@pytest.mark.skipif(not HAS_DATA, reason="no test tables here")
def test_classes_beat_single_words(spark):
    """Held-out texts of the tables are likelier under the class model than under the unigram model."""
    from corpusloom.llm.queries import op11_class_lm

    rows = op11_class_lm(spark, SF).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    base, _ = brute_base(texts, lambda r: zlib.crc32(str(r[0]).encode()) % 5 == 1)
    for r, b in zip(sorted(rows), sorted(base)):
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens) == b[:4] and r.base_score == pytest.approx(b[4])
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) and sum(r.score > r.base_score for r in held) > 0.75 * len(held)


def test_rows_written_twice_are_scored_twice(spark):
    df = documents(spark, [(1, "one two three", "en", "a")] * 3 + [(None, "one two", "en", "a")])
    assert set(CLASHES) & set(df.columns)
    got = class_lm.score(df, class_lm.fit(df, head=1))
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_known) for r in got.collect()) == [(0, 3, 3), (1, 4, 4), (1, 4, 4), (1, 4, 4)]
