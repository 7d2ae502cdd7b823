"""The corpus operators against brute force on a small table with nulls, blanks, repeats and very long texts."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from juriflow.llm import decontam, linededup, mixing, nearsets, perspectives, pitmanyor, quality, rollups, secrets, substrings
from juriflow.llm.common import Words, components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, rid int"


def prose(seed, n, v=400):
    r = random.Random(seed)
    return " ".join(f"w{int(v * r.random() ** 2)}{'.' if r.random() < 0.1 else ''}" for _ in range(n))


def table():
    passage, lines = prose(99, 60), "\n".join(prose(70 + k, 8) for k in range(9))
    base = prose(1, 150)
    near = base.split()
    near[40] = "changed"
    texts = [
        None, "", " \n\t ", "one", "one two three", base, base, " ".join(near), prose(2, 90) + "\n" + passage + "\n" + prose(3, 30), prose(4, 20) + " " + passage,
        prose(5, 50) + "\n" + lines + "\n" + prose(6, 40), lines + "\n" + prose(7, 60), "same line here\n" * 40, prose(8, 3000), "ação é ñandú " * 30, "### $$$ *** " * 40, "a b\x0bc\x0cd", "\x85  ",
    ]
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, len(t or ""), "clash", 7) for i, t in enumerate(texts)]
    rows += [rows[5], (None, base, "en", "s0", 1, "clash", 7), (None, None, None, None, None, None, None)]
    return rows


ROWS = table()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def split(text):
    return [b.decode() for b in (text or "").encode().split()]


def same(got, want):
    key = lambda x: tuple((v is None, str(v)) for v in x)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_words_and_runs():
    texts = ["a bb  ccc", "", None, " x\ny ", "é ü z", "a bb  ccc"]
    w = Words(pa.array(texts))
    assert w.counts.tolist() == [len(split(t)) for t in texts]
    hashes, whole = w.runs(3)
    assert whole.sum() == 2 and hashes[0] == hashes[w.first[5]] and w.hashes[0] != w.hashes[1]


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(5, 1, 0), (8, 1, 0), (15, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    want = []
    for r in ROWS:
        w = split(r[1])
        tri = Counter(zip(w, w[1:], w[2:]))
        covered = {j for i, t in enumerate(zip(w, w[1:], w[2:])) if tri[t] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in (r[1] or "").split("\n") if split(x)]
        n = len(w)
        want.append((r[0], n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in r[1] or ""), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n))
    got = quality.annotate(docs, labels)
    same(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect(), want)
    assert got.where("kept IS NULL OR (base_failed AND kept)").count() == 0
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns and kept.count() == got.where("kept").count() and kept.where("n_words <> 'clash'").count() == 0
    assert quality.annotate(none, labels.limit(0)).count() == 0


def brute_quality(rows, trusted, threshold=quality.THRESHOLD, smooth=quality.SMOOTH, buckets=quality.BUCKETS):
    """(score, kept) of each row, counted in plain dictionaries; the hashes are the engine's."""

    def h(*ws):
        out = 42
        for w in ws:
            out = xxhash.xxh64(w.encode(), out).intdigest()
        return out & (buckets - 1)

    grams = [[h(x) for x in w] + [h(a, b) for a, b in zip(w, w[1:])] for w in (split(r[1]) for r in rows)]
    raw, target = Counter(), Counter()
    for r, g in zip(rows, grams):
        raw.update(g)
        if r[0] in trusted:
            target.update(g)
    rate = (sum(target.values()) + 1) / (sum(raw.values()) + 1)
    out = []
    for r, g in zip(rows, grams):
        score = sum(math.log((target[x] / rate + smooth) / (raw[x] + smooth)) for x in g) / len(g) if g else 0.0
        w = split(r[1])
        tri = Counter(zip(w, w[1:], w[2:]))
        covered = {j for i, t in enumerate(zip(w, w[1:], w[2:])) if tri[t] > 1 for j in (i, i + 1, i + 2)}
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        out.append((score, not failed and score >= threshold))
    return out


def test_quality_against_brute_force(spark, docs):
    labels = spark.createDataFrame([(5, 1, 0), (8, 1, 0), (15, 0, 0), (13, 1, 1), (None, 1, 0), (8, 1, 0)], "doc_id long, quality int, toxic int")
    for threshold, smooth in ((quality.THRESHOLD, quality.SMOOTH), (0.05, 0.5)):
        want = [(r[0], round(x, 9), k) for r, (x, k) in zip(ROWS, brute_quality(ROWS, {5, 8}, threshold, smooth))]
        got = quality.annotate(docs, labels, threshold=threshold, smooth=smooth).select("doc_id", F.round("score", 9), "kept").collect()
        same(got, want)
        assert len({w[2] for w in want}) == 2


def test_line_dedup(docs, none):
    got = linededup.dedup(docs).where("doc_id IN (10, 11)").orderBy("doc_id").collect()
    assert got[0].removed_lines == 0 and 2 <= got[1].removed_lines <= 9
    seen = set()
    for r in got:
        lines = r.text.split("\n")
        assert len(lines) == r.n_lines - r.removed_lines
        seen |= set(lines)
    assert set(next(r[1] for r in ROWS if r[0] == 11).split("\n")) <= seen  # each line is left somewhere
    rows = linededup.dedup(docs)
    assert rows.count() == len(ROWS) and rows.where("text IS NULL").count() == 2 and linededup.dedup(none).count() == 0


def brute_chunks(text):
    """(lines of the chunk, what tells it) by the chunking's own definition, in plain integers."""
    m = (1 << 64) - 1

    def mix(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & m
        x = (x ^ x >> 27) * 0x94D049BB133111EB & m
        return x ^ x >> 31

    lines = text.split("\n")
    h = [mix(sum((b + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, b in enumerate(x.encode())) + len(x.encode()) & m) for x in lines]
    out, at = [], 0
    for i in range(len(lines)):
        roll = h[i] + (h[i - 1] * 0xD1342543DE82EF95 if i else 0) & m
        if i + 1 == len(lines) or (mix(roll) % 3 == 0 and i + 1 - at >= 2):
            short = i + 1 - at < 2 and out
            out.append((lines[at : i + 1], "\n".join((out[-1][0] if short else []) + lines[at : i + 1])))
            at = i + 1
    return out


def test_line_dedup_against_brute_force(spark):
    line = lambda k: prose(1000 + k, 6)
    passage = [line(k) for k in range(40)]
    texts = ["\n".join(line(100 * d + k) for k in range(1, 2 + d)) for d in range(1, 9)]
    texts += [f"{line(5000 + d)}\n" + "\n".join(passage) + f"\n{line(6000 + d)}\n{line(7000 + d)}" for d in range(4)]
    n = len(texts)
    texts += texts[:n] + ["\n".join([*passage, line(8000)]), "one line", "one line", "", "a\n", "a\n"]
    seen, want = set(), []
    for i, t in enumerate(texts):
        left = []
        for lines, told in brute_chunks(t):
            many = told.count("\n") > 0
            if not (many and told in seen):
                left += lines
            if many:
                seen.add(told)
        want.append((i, t.count("\n") + 1, t.count("\n") + 1 - len(left), "\n".join(left)))
    assert all(w[1] == w[2] for w in want[n : 2 * n])  # exact copies of several lines go wholly
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "", 0) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = linededup.dedup(docs).select("doc_id", "n_lines", "removed_lines", "text").collect()
    same(got, want)


def brute_windows(texts, window=35):
    ws = [split(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in ws for i in range(len(w) - window + 1))
    out = []
    for w in ws:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("group", [200_000, 3, 1])
def test_substring_dedup(docs, none, group):
    want = [(r[0], *w) for r, w in zip(ROWS, brute_windows([r[1] for r in ROWS]))]
    same(substrings.dedup(docs, group=group).collect(), want)
    assert substrings.dedup(none).count() == 0


def shingles(text, k=5):
    w = split(text)
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else Counter([tuple(w)] if w else [])


def jaccard(a, b):
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common)


def test_near_dedup(spark, docs, none):
    r = random.Random(5)
    cluster = []
    for i in range(40):  # a large group of near copies, above the size that is compared pair by pair
        w = prose(11, 120).split()
        w[r.randrange(120)] = f"edit{i}"
        cluster.append((100 + i, " ".join(w), "en", "s", 1, "", 0))
    rows = [*ROWS, *cluster]
    sets = [shingles(x[1]) for x in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and jaccard(a, b) >= 0.8:
                root[max(top(i), top(j))] = min(top(i), top(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(top(i), []).append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    want = [(rows[i][0], least[top(i)], len(groups[top(i)])) for i in range(len(rows))]
    got = nearsets.classes(spark.createDataFrame(rows, SCHEMA).repartition(2))
    same(got.select("doc_id", "class_id", "class_size").collect(), want)
    assert got.where("kept").count() == len(groups)
    assert nearsets.keep(docs).columns == docs.columns and nearsets.classes(none).count() == 0


@pytest.mark.parametrize("original", [True, False])
def test_near_dedup_of_copies_near_the_original_only(spark, original):
    r = random.Random(17)
    texts = []
    for i in range(120):  # similar to the original, the last row, and hardly to each other
        w = prose(12, 200).split()
        for k in range(4):
            w[r.randrange(10 + 48 * k, 40 + 48 * k) if i % 3 else 20 + 48 * k + i % 2] = f"edit{i}x{k}"
        texts.append(" ".join(w))
    texts += [prose(12, 200)] * original
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if root[i] != root[j] and jaccard(a, b) >= 0.8:
                root = [min(root[i], root[j]) if x in (root[i], root[j]) else x for x in root]
    assert len(set(root)) == 1 if original else len(set(root)) > 20
    rows = [(i, t, "en", "s", 1, "", 0) for i, t in enumerate(texts)]
    got = nearsets.classes(spark.createDataFrame(rows, SCHEMA).repartition(2))
    same(got.select("doc_id", "class_id", "class_size").collect(), [(i, root[i], root.count(root[i])) for i in range(len(rows))])


def test_near_dedup_of_a_template(spark):
    """300 texts of one template of 120 words with two edits each: every similar pair is in one class, no other."""
    r = random.Random(23)
    texts = []
    for i in range(300):
        w = prose(13, 120).split()
        for k in range(2):
            w[r.randrange(120)] = f"edit{i}x{k}"
        texts.append(" ".join(w))
    sets = [shingles(t) for t in texts]
    root, pairs = list(range(300)), []
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if jaccard(a, b) >= 0.8:
                pairs.append((i, j))
                x, y = sorted((root[i], root[j]))
                root = [x if z == y else z for z in root] if x != y else root
    rows = [(i, t, "en", "s", 1, "", 0) for i, t in enumerate(texts)]
    got = {r.doc_id: r.class_id for r in nearsets.classes(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert len(pairs) > 500 and got == dict(enumerate(root))


def test_components_in_rounds_and_in_one_task(spark):
    r = random.Random(2)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7)]
    edges = spark.createDataFrame(links, "u long, v long")
    one, many = ({(x.v, x.root) for x in components(edges, task_links=n).collect()} for n in (1_000_000, 0))
    assert one == many and (340, 300) in one and len(one) > 100
    assert components(edges.limit(0)).count() == 0


def test_bagminhash_is_unbiased():
    a, b = prose(21, 400) + " x y z q r" * 30, prose(21, 360) + " x y z q r" * 20
    w = Words(pa.array([a, b]))
    t = nearsets.signatures(*nearsets.multisets(w), 2, 8192)
    assert abs((t[0] == t[1]).mean() - jaccard(shingles(a), shingles(b))) < 0.03


def test_decontamination(spark, docs, none):
    items = [(1, prose(99, 60)), (2, prose(99, 58) + " other end"), (3, "one two three"), (4, None), (5, ""), (6, prose(50, 30)), (3, "one two three")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for r in ROWS:
        w = split((r[1] or "").lower())
        for i, t in items:
            x = split((t or "").lower())
            if not w or not x:
                continue
            best = max(jaccard(shingles(" ".join(x)), shingles(" ".join(w[s : s + len(x)]))) for s in range(max(1, len(w) - len(x) + 1)))
            if best >= 0.8:
                want.append((r[0], i, round(best, 9)))
    for limit in (1_000_000, 1):
        got = decontam.hits(docs, bench, broadcast_rows=limit).select("doc_id", "item_id", F.round("similarity", 9))
        same(got.collect(), want)
    assert decontam.hits(none, bench).count() == 0 and decontam.drop(docs, bench).count() == len(ROWS) - len({i for i, r in enumerate(ROWS) if r[0] in {x[0] for x in want}})


def test_decontamination_goes_through_the_index(spark):
    """Without a radius only equal fingerprints are met; with it none of the similar windows is lost; 70,000 shingles overflow nothing."""
    item = prose(60, 59, 4000).split()
    edited = [w if i != 30 else "edit" for i, w in enumerate(item)]
    long_ = prose(61, 70_000, 50_000)
    texts = [" ".join([*prose(62, 40).split(), *x, *prose(63, 40).split()]) for x in (item, edited)] + [f"{prose(64, 9)} {long_} tail"]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "", 0) for i, t in enumerate(texts)], SCHEMA)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, long_)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start_word, round(r.similarity, 6)) for r in decontam.hits(docs, bench).collect()}
    assert got == {(0, 1): (40, 1.0), (1, 1): (40, round(50 / 60, 6)), (2, 2): (9, 1.0)}
    assert {(r.doc_id, r.item_id) for r in decontam.hits(docs, bench, radius=0).collect()} == {(0, 1), (2, 2)}


def test_decontamination_recall(spark):
    """All of 120 windows at similarity 0.8 or just above are found, as by brute force."""
    r = random.Random(3)
    texts, items, want = [], [], set()
    for i in range(120):
        item = prose(500 + i, 50, 3000).split()
        x = list(item)
        for k in r.sample((0, 49, 24), 1):
            x[k] = f"edit{i}"
        items.append((i, " ".join(item)))
        texts.append((i, " ".join([*prose(900 + i, 20).split(), *x]), "en", "s", 1, "", 0))
        if max(jaccard(shingles(" ".join(item)), shingles(" ".join(texts[-1][1].split()[s : s + 50]))) for s in range(21)) >= 0.8:
            want.add((i, i))
    got = decontam.hits(spark.createDataFrame(texts, SCHEMA), spark.createDataFrame(items, "item_id long, text string"))
    assert {(x.doc_id, x.item_id) for x in got.collect()} == want and len(want) > 80


LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_model(rows, sweeps=3, burn=1, theta=1.0, seed=7):
    """predict(x, v, w) -> averaged probability, by dictionaries and customers that sit down one by one; hashes as the model's."""
    u = np.uint64
    texts = [[t.translate(LOW) for t in split(r[1])] for r in rows]
    known = {}
    for w in texts:
        for t, h in zip(w, Words(pa.array([" ".join(w)])).hashes):
            known[t] = h & pitmanyor._MASK
    h = lambda t: {"<end>": pitmanyor._END, "<start>": pitmanyor._START, "<before>": pitmanyor._BEFORE}.get(t) or known.get(t, u(12345))
    one = lambda x: np.array([x], u)
    pair = lambda v, w: pitmanyor.pair_key(one(h(v)), one(h(w)))[0]
    triple = lambda x, v, w: pitmanyor.triple_key(one(h(x) & pitmanyor._TAG), one(pair(v, w)))[0]
    c = Counter()
    for r, w in zip(rows, texts):
        if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10:
            seq = ["<before>", "<start>", *w, "<end>"]
            c.update(zip(seq, seq[1:], seq[2:]))
    vocabulary = {k[2] for k in c}

    def seat(n, a, d, key, salt):
        t = min(n, 1)
        stream = pitmanyor.mix(one(key) ^ pitmanyor.mix(one(u(salt))))
        for k in range(1, n):  # each customer after the first
            x = (float(pitmanyor.mix(stream + u(k * int(pitmanyor._STEP) & (1 << 64) - 1))[0] >> u(11)) + 1) * 2.0**-53
            t += x * (a + k - d * t) < a
        return t

    def up(tables, drop):
        out = Counter()
        for k, t in tables.items():
            out[k[drop:]] += t
        return out

    def discount(c):
        ones, twos = (sum(x == k for x in c.values()) for k in (1, 2))
        return min(0.95, max(0.05, (ones + 0.5) / (ones + 2 * twos + 1)))

    t3 = dict.fromkeys(c, 1)
    c2 = up(t3, 1)
    t2 = dict.fromkeys(c2, 1)
    c1 = up(t2, 1)
    t1 = dict.fromkeys(c1, 1)
    d1, d2, d3 = discount(c1), discount(c2), discount(c)
    held = Counter()
    for k, n in c.items():
        held[k[:2]] += n
    kept = []
    for number in range(1, sweeps + 2):
        n2, s2, s3 = Counter(), Counter(), Counter()
        for k, n in c2.items():
            n2[k[0]] += n
            s2[k[0]] += t2[k]
        for k, t in t3.items():
            s3[k[:2]] += t
        T, N = sum(t1.values()), sum(c1.values())
        state = (dict(c1), dict(t1), dict(c2), dict(t2), dict(t3), n2, s2, s3, T, N)

        def p0(w, s=state):
            return (s[0].get((w,), 0) - d1 * s[1].get((w,), 0) + (theta + d1 * s[8]) / (len(vocabulary) + 1)) / (theta + s[9])

        def p1(v, w, s=state, p0=p0):
            return (s[2].get((v, w), 0) - d2 * s[3].get((v, w), 0) + (theta + d2 * s[6][v]) * p0(w)) / (theta + s[5][v])

        def p2(x, v, w, s=state, p1=p1):
            return (c.get((x, v, w), 0) - d3 * s[4].get((x, v, w), 0) + (theta + d3 * s[7][x, v]) * p1(v, w)) / (theta + held[x, v])

        if number - 1 > burn:
            kept.append(p2)
        t3 = {k: seat(n, (theta + d3 * s3[k[:2]]) * p1(*k[1:]), d3, triple(*k), seed + 3 * number) for k, n in c.items()}
        c2 = up(t3, 1)
        t2 = {k: seat(n, (theta + d2 * s2[k[0]]) * p0(k[1]), d2, pair(*k), seed + 3 * number + 1) for k, n in c2.items()}
        c1 = up(t2, 1)
        t1 = {k: seat(n, (theta + d1 * T) / (len(vocabulary) + 1), d1, h(k[0]), seed + 3 * number + 2) for k, n in c1.items()}
    return (lambda x, v, w: sum(p(x, v, w) for p in kept) / len(kept)), c, vocabulary, texts


@pytest.mark.parametrize("deal", [(1, 2_000_000, 3_000_000), (5, 300, 200)])
def test_language_model_against_brute_force(spark, docs, none, deal):
    """Scores of a model that seats customer by customer, whichever way rows, chunks and hot contexts are dealt."""
    parts, chunk, bucket = deal
    predict, c, vocabulary, texts = brute_model(ROWS)
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0 for r in ROWS]
    n = Counter()
    for k, x in c.items():
        n[k[2]] += x
    total = sum(n.values())
    z = total + 0.1 * (len(n) + 1)
    want = {}
    for r, w, out in zip(ROWS, texts, held):
        seq = ["<before>", "<start>", *w, "<end>"]
        base = sum(math.log10((n[t] + 0.1) / z) for t in seq[2:])
        score = sum(math.log10(predict(*k)) for k in zip(seq, seq[1:], seq[2:]))
        want.setdefault((r[0], len(w)), (out, len(w) + 1, sum(n[t] > 0 for t in seq[2:]), total, base, score))
    for r in pitmanyor.score(docs.repartition(parts), chunk_tokens=chunk, bucket_tokens=bucket).collect():
        x = want[r.doc_id, r.n_tokens - 1]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == x[:4]
        assert abs(r.base_score - x[4]) < 1e-6 and abs(r.score - x[5]) < 1e-6
    assert pitmanyor.score(none).count() == 0
    # over all known words and one unknown, probabilities sum to 1, after contexts that were met and others
    for x, v in [("<before>", "<start>"), ("<start>", "one"), *[k[:2] for k in list(c)[:3]], ("never", "met"), ("never", "w1")]:
        assert abs(sum(predict(x, v, w) for w in [*vocabulary, "no such word"]) - 1) < 1e-9


def test_language_model_without_training(spark):
    rows = [(i, t, "en", "s", 1, "", 0) for i, t in ((10, "a b"), (None, None)) if zlib.crc32(str(i or "").encode()) % 10 == 0]
    got = pitmanyor.score(spark.createDataFrame(rows or [(None, "a b", "en", "s", 1, "", 0)], SCHEMA)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 and abs(r.score) < 1e-9 for r in got)


def test_lm_order_of_hashes_sorted_with_their_places():
    """As a stable argsort, also of hashes that only low bits tell apart, which places take the room of."""
    r = np.random.default_rng(3)
    some = r.integers(0, 1 << 64, 5000, np.uint64)
    for x in (some[:0], some[:1], np.repeat(some[:1], 9), some, np.concatenate([some, some ^ np.uint64(1), some, some ^ np.uint64(6)]), r.integers(0, 50, 9000).astype(np.uint64)):
        assert (pitmanyor._order(x) == np.argsort(x, kind="stable")).all()
        for a, b in zip(pitmanyor._distinct(x), np.unique(x, return_index=True, return_inverse=True)):
            assert (a == b).all()


def test_seating(monkeypatch):
    """Tables are those of customers that toss a coin one by one, in the mean, however draws are cut into pieces."""
    n, c, a, d = 4000, 60, 0.8, 0.6
    monkeypatch.setattr(pitmanyor, "DRAWS", 1000)
    t = pitmanyor.seat(np.full(n, c), np.full(n, a), d, pitmanyor.mix(np.arange(n).astype(np.uint64)), 1)
    rng, slow = np.random.default_rng(0), np.ones(n)
    for k in range(1, c):
        slow += rng.random(n) < a / (a + k - d * slow)
    assert abs(t.mean() - slow.mean()) < 0.15 and ((1 <= t) & (t <= c)).all()
    key = pitmanyor.mix(np.arange(5).astype(np.uint64))
    c = np.array([0, 1, 2, 700, 90])
    pieces = pitmanyor.seat(c, np.full(5, 40.0), 0.8, key, 2)
    monkeypatch.setattr(pitmanyor, "DRAWS", 1 << 20)
    assert (pieces == pitmanyor.seat(c, np.full(5, 40.0), 0.8, key, 2)).all()


def test_mixing(docs, none):
    got = mixing.take(docs, blocks=4).collect()
    assert len(got) == len(ROWS)
    per = {}
    for r in got:
        per.setdefault(r.source, []).append(r)
        assert 0 <= r.taken <= 2 * r.size and r.size == len(split(r.text))
    total = sum(r.size for r in got)
    for rows in per.values():
        assert sum(r.size for r in rows) == rows[0].source_size and abs(sum(r.taken for r in rows) - rows[0].target) <= 1
    assert abs(sum(rows[0].target for rows in per.values()) - 1.5 * total) < 1e-6
    mixed = mixing.mix(docs, blocks=4).collect()
    assert sum(r.take_words for r in mixed) == sum(r.taken for r in got) and all(len(split(r.text)) == r.take_words for r in mixed)
    assert mixing.take(none).count() == 0


def test_perspectives(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (1, None, "ann", "late"), (2, 0, "system", "x"), (None, 5, None, "who")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.perspective): r for r in perspectives.dialogues(turns, block=2).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (None, "unknown")}
    r = got[1, "ann"]
    want = ("system\nbe kind", "assistant\nhi < |im_end|>", "user name=bob\n", "user name=bob\n", "assistant\nlate")
    assert r.text == "".join(f"<|im_start|>{x}<|im_end|>\n" for x in want)
    assert [r.text[s.start : s.end] for s in r.spans] == ["hi < |im_end|><|im_end|>\n", "late<|im_end|>\n"]


def test_perspectives_of_hot_turns(spark):
    """Many turns of one number, without a number and equal ones, cut into small blocks: places are those of the plain order."""
    r = random.Random(4)
    rows = [("null", r.choice([None, 0, 3, 3, 700]), r.choice(["ann", "bob", "system"]), r.choice([None, "same", f"t{r.randrange(9)}" * r.randrange(1, 30)])) for _ in range(300)]
    rows += [(None, 1, "cy", "x")]
    schema = "conv_id string, turn long, role string, text string, start string"
    turns = spark.createDataFrame([(*x, "clash") for x in rows], schema).repartition(3)
    for most in (10, 10_000):
        got = perspectives.dialogues(turns, block=2, most=most).collect()
        assert {(x.conv_id, x.perspective) for x in got} == {("null", "ann"), ("null", "bob"), (None, "cy")}
        for x in got:
            mine = sorted((t is None, t or 0, s, (m or "")) for c, t, s, m in rows if c == x.conv_id)
            role = lambda s: "system" if s == "system" else "assistant" if s == x.perspective else f"user name={s}"
            assert x.text == "".join(f"<|im_start|>{role(s)}\n{m}<|im_end|>\n" for _, _, s, m in mine)
            assert [x.text[a.start : a.end] for a in x.spans] == [f"{m}<|im_end|>\n" for _, _, s, m in mine if s == x.perspective]
    assert perspectives.rotate(turns.limit(0)).count() == 0


def test_rollups(spark, docs, none, tmp_path):
    rollup = rollups.Rollup(spark, str(tmp_path / "r"))
    assert rollup.totals().count() == 0
    first = rollups.changes(docs, "words-v1", 1)
    assert rollup.commit("1", first) and not rollup.commit("1", first)
    assert rollup.commit("2", rollups.changes(none, "words-v1", 1))
    half = docs.where("doc_id < 9")
    rollup.commit("3", rollups.changes(half, "words-v1", -1))
    rest = docs.where("doc_id >= 9 OR doc_id IS NULL")
    rollup.commit("4", rollups.revisions(rest, "words-v1", "pieces-v2"))
    want = Counter()
    for r in ROWS:
        if r[0] is None or r[0] >= 9:
            want[r[3], r[2]] += 1
    for _ in range(2):
        got = rollup.totals().collect()
        assert {(x.source, x.lang): x.n_docs for x in got} == dict(want) and {x.tokenizer for x in got} == {"pieces-v2"}
        rollup.compact()
    assert not rollup.commit("3", rollups.changes(half, "words-v1", -1))


def sums(rollup):
    return sorted(((r.source or "", r.lang or "", r.n_docs, r.n_tokens) for r in rollup.totals().collect()))


def test_rollup_batches_that_break_off_or_come_again(spark, docs, tmp_path):
    path = tmp_path / "r"
    rollup = rollups.Rollup(spark, str(path))
    some = docs.where("doc_id < 5")
    rollup.commit("a", rollups.changes(some, "words-v1", 1))
    rollup.commit("b", rollups.changes(docs.where("doc_id >= 5"), "words-v1", 1))
    want = sums(rollup)
    # broken off before its marker stood: a folder that nothing tells of
    rollups.changes(some, "words-v1", 1).write.parquet(str(path / "data" / "left"))
    assert sums(rollup) == want
    with pytest.raises(ValueError):
        rollup.commit("a", rollups.changes(docs, "words-v1", 1))
    markers = {p.name: p.read_bytes() for p in (path / "commits").iterdir()}
    assert rollup.compact() and sums(rollup) == want and not list((path / "commits").glob("[!.]*"))
    # a fold that broke off while it cleaned up: markers of folded batches still stand
    for name, content in markers.items():
        (path / "commits" / name).write_bytes(content)
    assert sums(rollup) == want and not rollup.commit("a", rollups.changes(some, "words-v1", 1))
    with pytest.raises(ValueError):
        rollup.commit("b", rollups.changes(some, "words-v1", 1))
    assert rollup.commit("c", rollups.changes(some, "words-v1", -1))
    assert rollup.compact() and rollup.compact()
    assert not rollup.commit("c", rollups.changes(some, "words-v1", -1)) and not rollup.commit("a", rollups.changes(some, "words-v1", 1))
    left = docs.where("doc_id >= 5").groupBy("source", "lang").count().collect()
    assert sorted((r.source or "", r.lang or "", r["count"]) for r in left) == [x[:3] for x in sums(rollup)]
    assert len(list((path / "data").glob("[!.]*"))) == 2  # the fold's, and the one left behind


def test_rollup_takes_any_name(spark, docs, none, tmp_path):
    """Names that mean something to paths, to folds or to URLs are names like others."""
    rollup = rollups.Rollup(spark, str(tmp_path / "r"))
    names = ["a/b", "fold-a", "day 1", "day%201", "..", "ação é", "x" * 300, "*", "_hidden", ".hidden", "a\nb"]
    one = docs.where("doc_id = 13")
    for k, name in enumerate(names):
        assert rollup.commit(name, rollups.changes(one, "words-v1", 1)), name
        assert not rollup.commit(name, rollups.changes(one, "words-v1", 1))
        if k % 4 == 3:
            assert rollup.compact()
        assert [x[2:] for x in sums(rollup)] == [(k + 1, 3000 * (k + 1))]
    assert rollup.compact() and rollup.commit("none", rollups.changes(none, "words-v1", 1)) and rollup.compact()
    for name in [*names, "none"]:
        assert not rollup.commit(name, rollups.changes(none if name == "none" else one, "words-v1", 1)), name
    with pytest.raises(ValueError):
        rollup.commit("day 1", rollups.changes(docs, "words-v1", 1))
    for bad in ("", None):
        with pytest.raises(ValueError):
            rollup.commit(bad, rollups.changes(one, "words-v1", 1))
    assert [x[2:] for x in sums(rollup)] == [(len(names), 3000 * len(names))]


def test_rollup_writers_at_once(spark, docs, tmp_path):
    """Two writers of one batch, and a batch that comes between another's look and its marker: it counts once."""
    first, second = (rollups.Rollup(spark, str(tmp_path / "r")) for _ in range(2))
    one = rollups.changes(docs.where("doc_id = 13"), "words-v1", 1)
    asked = first._known
    first._known = lambda key: None if second.commit("a", one) else asked(key)  # the other commits after the first has looked
    assert not first.commit("a", one)
    assert [x[2:] for x in sums(first)] == [(1, 3000)] and len(list((tmp_path / "r" / "data").glob("[!.]*"))) == 1
    first._known = lambda key: None if second.commit("b", one) else asked(key)
    with pytest.raises(ValueError):
        first.commit("b", rollups.changes(docs, "words-v1", 1))
    # two folds of the same batches: one stands
    first._known = asked
    made = first._create
    first._create = lambda path, content: made(path, content) if second.compact() else None
    assert not first.compact() and [x[2:] for x in sums(first)] == [(2, 6000)]
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(4) as pool:
        told = list(pool.map(lambda _: rollups.Rollup(spark, str(tmp_path / "r")).commit("c", one), range(4)))
    assert any(told) and [x[2:] for x in sums(second)] == [(3, 9000)]


def test_mixing_ties_and_missing_ids(spark):
    """Rows of one id and size but different texts, and many without an id: reruns on other partitions take the same words."""
    rows = [(7, f"w{i} x y z", "en", "s", 1, "", 0) for i in range(9)] + [(None, f"n{i} a b", "en", "s", 1, "", 0) for i in range(40)]
    got = []
    for parts in (1, 5):
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        got.append(sorted((r.text, r.take_words, r.copy) for r in mixing.mix(df, blocks=4, share=1.3).collect()))
    assert got[0] == got[1] and sum(x[1] for x in got[0]) == round(1.3 * 156)
    keys = spark.createDataFrame(rows, SCHEMA).select(mixing.hash_key(F.col("doc_id"), F.col("text")).alias("k")).distinct().count()
    assert keys == 41


def test_very_long_texts(spark):
    """100,000 words, twice and once with a word changed, through every operator on documents."""
    words = prose(77, 100_000, 3000).split()
    lines = lambda w: "\n".join(" ".join(w[i : i + 12]) for i in range(0, len(w), 12))
    near = [*words[:50_000], "changed", *words[50_001:]]
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    long_ = spark.createDataFrame([(i, lines(w), "en", "s", 1, "", 0) for i, w in ((1, words), (2, words), (3, near))], SCHEMA)
    left = {r.doc_id: r for r in linededup.dedup(long_).collect()}
    assert (left[1].removed_lines, left[2].removed_lines, left[2].n_lines) == (0, 8334, 8334) and 8300 <= left[3].removed_lines < 8334
    assert {(r.size, r.taken) for r in mixing.take(long_).collect()} == {(100_000, 150_000), (100_000, 100_000), (100_000, 200_000)}
    assert {(r.doc_id, r.n_words, r.n_removed) for r in substrings.dedup(long_).collect()} == {(1, 100_000, 100_000), (2, 100_000, 100_000), (3, 100_000, 99_999)}
    assert {(r.class_id, r.class_size) for r in nearsets.classes(long_).collect()} == {(1, 3)}
    scored = {r.doc_id: r for r in pitmanyor.score(long_).collect()}
    assert {r.n_tokens for r in scored.values()} == {100_001} and all(r.score < 0 for r in scored.values())
    assert {r.n_words for r in quality.annotate(long_, labels).collect()} == {100_000}
    assert rollups.changes(long_, "words-v1", 1).agg(F.sum("n_tokens")).head()[0] == 300_000


def test_secrets(spark, none):
    """Against planted truth: the forest on held-out findings, and against a plain rule over the neighbourhood."""
    docs = spark.createDataFrame([(i, prose(i, 200, 30).replace("w", "word"), "en", "s", 1, "", 0) for i in range(40)], SCHEMA)
    letters = docs.withColumn("text", F.translate("text", "0123456789.", "abcdefghij "))
    known = secrets.lexicon(letters)
    assert known.words.count() > 10 and len(known.transitions) == 784
    found = secrets.findings(secrets.planted(spark, known, n=4000), known).cache()
    forest = secrets.train(found.where("NOT held_out"))
    held = found.where("held_out")
    got = secrets.evaluate(held, f"{forest} >= 0.5D")
    rule = secrets.evaluate(held, "near_assign > 0 AND near_credential > 0 AND digit_share > 0.15")
    assert got["n"] > 500 and got["precision"] > 0.85 and got["recall"] > 0.85
    assert got["precision"] > rule["precision"] + 0.05 and got["recall"] > rule["recall"] + 0.3
    assert secrets.train(found.limit(0)) == "0.5D" and secrets.scan(none, forest, known).count() == 0
    assert secrets.train(found.where("label = 1")) == "1.0D" and secrets.lexicon(none).words.count() == 0
    # apart for known and unknown paths, and for each kind
    for known_path in (0.0, 1.0):
        part = secrets.evaluate(held.where(F.col("path_known") == known_path), f"{forest} >= 0.5D")
        assert part["n"] > 200 and part["precision"] > 0.85 and part["recall"] > 0.85, (known_path, part)
    told = secrets.report(held, f"{forest} >= 0.5D").collect()
    assert sum(r.n for r in told) == got["n"] and all((r.recall is None) == (r.secrets == 0) for r in told)
    hexed = {(r.path_known, r.kind): r for r in told}
    assert all(hexed[p, k].recall >= 0.5 for p in (0.0, 1.0) for k in range(4)) and (0.0, 14) not in hexed  # no kind is lost; no fixture without its path
    assert hexed[1.0, 14].fp < 0.3 * hexed[1.0, 14].n and hexed[0.0, 7].fp < 0.2 * hexed[0.0, 7].n
    found.unpersist()


def test_secrets_in_documents(spark):
    """Strings of known truth written into whole documents, which have no path: nine in ten are found, and little else is."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("aeiounrstlm") for _ in range(r.randint(3, 8)))
    words = [word() for _ in range(300)]
    hexed = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    base = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    rows, truth = [], {}
    for i in range(300):
        text = [r.choice(words) for _ in range(200)]
        good = (hexed(40), hexed(32), base(40), "AKIA" + base(16).upper(), "sk_live_" + base(24))[i % 5]
        lead = (["token", "="], ["api_key:"], ["client_secret", "="], ["access", "key"], ["SECRET:"])[i % 5]
        bad = (["commit", hexed(40)], ["sha256:", hexed(64)], ["".join(r.choice(words) for _ in range(6))], ["card", str(r.randint(10**15, 10**16 - 1))], ["/".join(r.choice(words) for _ in range(6))])[i // 5 % 5]
        at = r.randint(0, 190)
        text[at:at] = [*lead, f'"{good}"' + r.choice(["", "###", "."])]
        text += bad
        rows.append((i, " ".join(text), "en", "s", 1, "", 0))
        truth[good] = 1
        truth[bad[-1]] = 0
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    known = secrets.lexicon(docs)
    forest = secrets.train(secrets.findings(secrets.planted(spark, known), known).where("NOT held_out"))
    got = {x.candidate: x.is_secret for x in secrets.scan(docs, forest, known).collect()}
    recall = sum(got.get(k, False) for k, v in truth.items() if v) / sum(truth.values())
    wrong = sum(got.get(k, False) for k, v in truth.items() if not v) / sum(1 - v for v in truth.values())
    assert recall >= 0.9 and wrong <= 0.1 and any(got.values()) and not all(got.values()), (recall, wrong)
    with pytest.raises(ValueError):
        secrets.candidates(docs.withColumn("Length", F.lit(1)), known, key=("Length",))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the driver's tables")
def test_secrets_of_the_table(spark):
    """The query over the driver's documents finds the token lines that stand in them, and no ordinary word."""
    from juriflow.llm.queries import QUERIES

    got = QUERIES["op3_secrets"](spark, "/root/testdata/sf0.01").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    lines = {(i, m) for i, t in docs.items() for m in re.findall(r'token = "([0-9a-f]{40})"', t or "")}
    found = {(r.doc_id, r.candidate) for r in got if r.is_secret}
    assert len(lines) >= 10 and len(lines & found) >= 0.9 * len(lines)
    assert len(found - lines) <= 0.1 * len(found)


def test_secret_candidates(spark):
    known = secrets.Lexicon(spark.createDataFrame([("word", 9), ("deed", 9)], "word string, n long"), [-1.0] * 784)
    key = "0123456789abcdef0123"
    texts = [None, "", f"api_key={key} x", f'token = "{key}" and {key}', "wordwordwordword deeds", "short0123456789", f"({key}==)", "a" * 70_000, f"{key},{key}"]
    rows = [(i, t, "en", "s", 1, "", 0) for i, t in enumerate([*texts, texts[2]])] + [(2, texts[2], "en", "s", 1, "", 0)]
    got = {}
    for r in secrets.candidates(spark.createDataFrame(rows, SCHEMA), known).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sorted(got) == [2, 3, 4, 6, 7, 8, 9]
    assert [(r.candidate, r.word_index, r.near_credential, r.near_assign) for r in got[2]] == [(key, 0, 1.0, 1.0)] * 2  # repeated rows are rows
    assert sorted((r.word_index, r.near_credential, r.near_assign) for r in got[3]) == [(2, 1.0, 1.0), (4, 0.0, 0.0)]
    assert got[4][0].dictionary_share == 1.0 and got[6][0].candidate == f"{key}==" and got[7][0].length == 70_000 and len(got[8]) == 2
    assert all(r.path_known == 0 and abs(r.transitions + (r.length - 1) / r.length) < 1e-9 for rs in got.values() for r in rs)


def brute_mix(rows, share=1.5, most=2):
    """(doc_id, copy, take_words) of (doc_id, source, words)."""
    names = sorted({r[1] for r in rows}, key=lambda x: (x is None, x))
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    size = {n: sum(len(r[2]) for r in rows if r[1] == n) for n in names}
    left, target = set(names), {}
    while left:
        level = (share * sum(size.values()) - sum(target.values())) / sum(weight[n] for n in left)
        full = {n for n in left if level * weight[n] >= most * size[n]}
        target |= {n: most * size[n] for n in full} if full else {n: level * weight[n] for n in left}
        left = left - full if full else set()
    out = []
    for n in names:
        goal, front = round(target[n]), 0
        key = lambda r: int(hashlib.md5(f"{mixing.SEED}/{r[0]}".encode()).hexdigest()[:15], 16)
        for r in sorted((r for r in rows if r[1] == n), key=key):
            taken = goal // size[n] * len(r[2]) + max(0, min(len(r[2]), goal % size[n] - front))
            front += len(r[2])
            out += [(r[0], k + 1, min(len(r[2]), taken - k * len(r[2]))) for k in range(-(-taken // len(r[2])))]
    return out


def test_pipeline_against_brute_force(spark, tmp_path):
    """Every stage restated in plain Python, one after the other."""
    lines = "\n".join(prose(70 + k, 8) for k in range(9))
    rows = [(i, prose(200 + i, 120) + "\n" + prose(300 + i, 60), f"s{i % 2}") for i in range(14)]
    near = rows[3][1].split(" ")
    near[70] = "changed"
    rows += [(14, rows[0][1], "s0"), (15, prose(400, 80) + "\n" + prose(99, 60) + "\n" + prose(401, 30), "s1"), (16, "short", "s1"), (17, " ".join(near), "s1"), (18, None, None)]
    rows += [(20 + i, f"{prose(500 + i, 70)}\n{lines}\n{prose(600 + i, 50)}", None) for i in range(3)] + [(30, "ab cd ef " * 40, "s0")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_lines int"
    spark.createDataFrame([(i, t, "en", x, len(t or ""), 5) for i, t, x in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(12)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    item = prose(99, 60)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = [r for r, (_, k) in zip(rows, brute_quality(rows, set(range(12)))) if k]
    seen, left = set(), []
    for i, t, x in kept:
        stay = []
        for chunk, told in brute_chunks(t):
            if "\n" in told and told in seen:
                continue
            stay += chunk
            seen |= {told} if "\n" in told else set()
        if stay:
            left.append((i, "\n".join(stay), x))
    sets, unique = [], []
    for r in left:
        mine = shingles(r[1])
        if not any(jaccard(mine, other) >= 0.8 for other in sets):
            unique.append(r)
            sets.append(mine)
    n = len(split(item))
    clean = [r for r in unique if max(jaccard(shingles(item), shingles(" ".join(split(r[1])[s : s + n]))) for s in range(max(1, len(split(r[1])) - n + 1))) < 0.8]
    want = brute_mix([(i, x, split(t)) for i, t, x in clean])
    assert len(rows) > len(kept) > len(left) - 1 and len(kept) > len(unique) > len(clean) > 10 and {20, 21, 22} <= {r[0] for r in clean}
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert {*schema.replace(",", "").split()[::2]} <= {*got.columns}
    same(got.select("doc_id", "copy", "take_words").collect(), want)
    words = {i: split(t) for i, t, _ in clean}
    assert all(split(r.text) == words[r.doc_id][: r.take_words] for r in got.collect())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "mixing"]


def test_pipeline_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
