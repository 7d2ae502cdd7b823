"""Language identification, lexical search and conversation repair against brute force."""

import hashlib
import math
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from juriflow.llm import langid, lexical, repair
from juriflow.llm.common import Words
from juriflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, score string, rank long"


def prose(seed, n, kind):
    r = random.Random(seed)
    parts = {"en": ("th", "ing", "the", "on", "er", "ly"), "fr": ("é", "que", "tion", "le", "ou", "aux"), "zh": ("你", "好", "的", "是", "中", "文")}[kind]
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(n)) + r.choice([".", "!", " 12", ""])


def documents():
    rows = [(i, prose(i, 3 + i % 40, ("en", "fr", "zh", "en")[i % 4]), ("en", "fr", "zh", "en")[i % 4], f"s{i % 3}", "clash", 7) for i in range(80)]
    rows += [(80, None, "en", "s", None, None), (81, "", "fr", None, None, None), (82, " 12 .\n", "en", None, None, None), (83, prose(5, 30, "fr"), None, None, None, None)]
    rows += [(None, prose(6, 30, "zh"), "zh", None, None, None), (None, None, None, None, None, None), rows[3], rows[3]]
    rows += [(84, prose(8, 20_000, "en"), "en", None, None, None), (85, "\x00A\x0bÉé İ ﬃ 𝔘𐐀", "fr", None, None, None), (86, "x", "en", None, None, None), (87, "THE the The", "", None, None, None)]
    return rows


ROWS = documents()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def same(got, want):
    key = lambda x: tuple((v is None, str(v)) for v in x)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


# ---- language identification --------------------------------------------------------------------------------------


def brute_grams(text, buckets):
    m, read = (1 << 32) - 1, [0]
    for c in (text or "").lower():
        if c.isalpha():
            read.append(ord(c))
        elif read[-1]:
            read.append(0)
    if read[-1]:
        read.append(0)
    out = []
    for n in langid.SIZES:
        for i in range(len(read) - n + 1):
            h = read[i] * 0x9E3779B1 & m
            for c in read[i + 1 : i + n]:
                h = ((h ^ h >> 15) * 0x85EBCA77 + c * 0x9E3779B1) & m
            h = (h ^ h >> 16) * 0xC2B2AE3D & m
            out.append((h ^ h >> 13) & buckets - 1)
    return out


def brute_languages(rows, buckets):
    held = [zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 3 == 1 for r in rows]
    grams = [brute_grams(r[1], buckets) for r in rows]
    counts, n_docs = defaultdict(Counter), Counter()
    for r, h, g in zip(rows, held, grams):
        if not h and r[1] is not None and r[2] is not None:
            counts[r[2]].update(g)
            n_docs[r[2]] += 1
    out = []
    for r, h, g in zip(rows, held, grams):
        if not any(c.isalpha() for c in r[1] or "") or not n_docs:
            out.append((r[0], h, "und", 0.0))
            continue
        logs = {}
        for lang in sorted(n_docs):
            total = sum(counts[lang].values()) + langid.SMOOTH * buckets
            logs[lang] = math.log(n_docs[lang]) + sum(math.log((counts[lang][x] + langid.SMOOTH) / total) for x in g)
        best = max(logs, key=logs.get)
        out.append((r[0], h, best, round(1 / sum(math.exp(x - logs[best]) for x in logs.values()), 3)))
    return out


def test_languages_against_brute_force(docs):
    want = brute_languages(ROWS, 1 << 10)
    for at_once in (langid.AT_ONCE, 1, 2):
        got = langid.label(docs, buckets=1 << 10, at_once=at_once)
        assert got.columns == [*[c for c in docs.columns if c != "score"], "lang_pred", "score", "held_out"]
        same(got.select("doc_id", "held_out", "lang_pred", F.round("score", 3)).collect(), want)
    assert {w[2] for w in want} >= {"en", "fr", "zh", "und"}


def test_languages_are_the_same_however_rows_are_dealt(docs, monkeypatch):
    one = langid.label(docs.repartition(1)).drop("text").collect()
    monkeypatch.setattr(langid, "HELD", 1)
    same(langid.label(docs.repartition(9)).drop("text").collect(), [tuple(r) for r in one])
    same(langid.label(docs, keep_text=False).collect(), [tuple(r) for r in one])
    assert {(r.doc_id, r.text) for r in langid.label(docs).collect()} == {(r[0], r[1]) for r in ROWS}


def test_languages_of_nothing(docs, none):
    assert langid.label(none).count() == 0
    untaught = langid.label(docs.withColumn("lang", F.lit(None).cast("string")))
    assert untaught.where("lang_pred = 'und' AND score = 0").count() == len(ROWS)
    with pytest.raises(ValueError):
        langid.learn(docs, buckets=1000)


def test_bytes_that_are_no_text():
    grams = langid.Grams(pa.array([b"\xff\xfe", b"ab\xffcd", None, b""]), 1 << 10)
    assert grams.lettered.tolist() == [False, True, False, False]
    assert sum(map(len, grams.parts)) == len(brute_grams("ab�cd", 1 << 10))


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    judged = QUERIES["op11_language_id"](spark, SF).join(truth, "doc_id").where("held_out AND lang IS NOT NULL AND lang_pred <> 'und' AND length(text) >= 100")
    right, every = judged.agg(F.count_if(F.expr("lang = lang_pred")), F.count("*")).head()
    assert every > 200 and right / every >= 0.97


# ---- lexical search ---------------------------------------------------------------------------------------------


def brute_terms(text):
    out, run = [], b""
    for b in (text or "").encode() + b" ":
        c = chr(b)
        if b >= 128 or c.isalnum():
            run += c.lower().encode("latin-1") if b < 128 else bytes([b])
        elif run:
            out.append(run)
            run = b""
    return out


def brute_search(rows, items, k=10):
    held = [Counter(brute_terms(r[1])) for r in rows]
    sizes = [sum(h.values()) for h in held]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    out = []
    for item_id, text in items:
        found = []
        for r, h, n in zip(rows, held, sizes):
            score = 0
            for t in set(brute_terms(text)):
                df = sum(t in x for x in held)
                if h[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    score += w * (1_000_000_000 * h[t] // (1000 * h[t] + 8 * (10 + 90 * n * n_docs // n_terms)))
            if score > 0:
                found.append((-score, r[0] is None, r[0] or 0))
        out += [(item_id, i, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(found)[:k], 1)]
    return out


ITEMS = [
    (1, prose(3, 30, "zh")), (2, prose(4, 30, "en") + " THE-thing"), (2, prose(9, 12, "fr")), (3, None), (4, " .-"), (None, "the"), (5, "absent words only"),
    (6, prose(2, 40, "fr") + " " + "verylong" * 20), (7, "the " * 50), (8, "X"),
]


def test_search_against_brute_force(spark, docs):
    items = spark.createDataFrame([(*x, "clash") for x in ITEMS], "item_id long, text string, doc_id string")
    want = brute_search(ROWS, ITEMS)
    same(lexical.rank(docs, items).collect(), want)
    same(lexical.rank(docs, items, block_terms=20, shard=50).collect(), want)  # many blocks, many shards
    same(lexical.rank(docs.repartition(1), items, k=3, shard=7).collect(), brute_search(ROWS, ITEMS, 3))
    assert {w[0] for w in want} == {1, 2, 5, 6, 7, 8, None}


def test_search_of_nothing(spark, docs, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.rank(none, items).count() == 0
    assert lexical.rank(docs, items.limit(0)).count() == 0
    assert lexical.rank(docs, items, k=3).schema.simpleString() == "struct<item_id:bigint,rank:int,doc_id:bigint,score:bigint>"


def test_ties_go_to_the_least_ids(spark):
    rows = [(i, "alpha beta" if i % 2 else "alpha beta gamma", None, None, None, None) for i in random.Random(1).sample(range(400), 400)]
    items = spark.createDataFrame([(1, "alpha beta"), (2, "gamma alpha")], "item_id long, text string")
    got = lexical.rank(spark.createDataFrame(rows, SCHEMA).repartition(7), items, shard=30).orderBy("item_id", "rank").collect()
    assert [r.doc_id for r in got] == [*range(1, 20, 2), *range(0, 20, 2)]


def test_the_threshold_stops_early():
    """On lists of falling impacts only a small part of the postings is read, and the result is that of reading all."""
    r = np.random.default_rng(1)
    n_docs, n_terms = 20_000, 30
    held = r.random((n_docs, n_terms)) < np.linspace(0.02, 0.5, n_terms)
    held[:12, :8] = True  # a dozen that have the whole item, often
    doc, term = np.nonzero(held)
    tf = r.geometric(0.6, len(doc))
    tf[(doc < 12) & (term < 8)] += 40
    sizes, n = held.sum(axis=1), r.integers(1000, 3000, n_docs)
    some = sizes > 0
    weights = np.array([lexical.weight(n_docs, int(x)) for x in held.sum(axis=0)])
    items = lexical.Items(np.array([0, 8]), np.arange(8), weights, n_docs, int(n.sum()))
    shard = lexical.Shard(np.flatnonzero(some), np.zeros(some.sum(), bool), n[some], sizes[some], term, tf, items)
    own = np.where(np.arange(n_terms) < 8, weights, 0)
    read = []
    best = shard.top(1, np.arange(8), own, (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)), 10, read)
    every = shard.scores(np.arange(some.sum()), own)
    order = np.lexsort((shard.ids, -every))[:10]
    assert best[2].tolist() == shard.ids[order].tolist() and best[0].tolist() == every[order].tolist()
    assert sum(read) < 0.1 * (term < 8).sum()


def test_terms_are_told_apart_by_their_bytes():
    """Words of one hash but other bytes are no matches."""
    known = lexical.Vocabulary(["alpha", "beta", "long" * 20])
    words = Words(pa.array(["Alpha beta alpha " + "long" * 20 + " " + "long" * 19 + "lonx"]), lower=True, gap=lexical._GAP)
    assert known.find(words)[1].tolist() == [0, 1, 0, 2]
    known.data = known.data.copy()
    known.data[known.starts[1]] = ord("x")
    known.data[known.starts[2] + 70] = ord("x")
    assert known.find(words)[1].tolist() == [0, 0]


# ---- conversation repair ------------------------------------------------------------------------------------------

_SPACE = " \t\n\x0b\x0c\r"
CONVERSATIONS = "conv_id long, turn long, role string, text string, n string"


def conversations(n=60, seed=3):
    r = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(r.randint(1, 9)):
            role = ("user", "assistant")[turn % 2] if r.random() < 0.7 else r.choice(["system", "user", "assistant", "tool", "", None])
            text = r.choice(["Same.", "Hello?", "Open end", "", " \n", None, f"Text {r.randint(0, 5)}.", "Done!  \n", "no. stop"])
            at = None if r.random() < 0.05 else turn + r.choice([0, 0, 0, 1, 5])
            rows.append((conv, at, role, text, "clash"))
            if r.random() < 0.1:
                rows.append(rows[-1])
    rows += [(7_000_000, t % 50, ("user", "assistant", "system")[t % 3], f"Line {t % 40}" + ".?"[t % 2 :] * (t % 5 > 0), None) for t in range(700)]
    rows += [(8_000_000, 1, "user", "Often.", None)] * 300 + [(8_000_000, t, "assistant", "x" * 50_000 + ".", None) for t in range(2, 9)]
    return rows


def brute_damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        out[conv]
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute_repair(rows):
    """Plain dynamic programming over all rows and states, with the whole audits."""
    out = []
    for conv, held in brute_damage(rows).items():
        held.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        seen, faults = set(), []
        for _, role, text in held:
            bare = text.strip(_SPACE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, *_ in held if t is not None]
        initials = [role[:1] for _, role, _ in held]
        step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
        best = {"": (0, "", ())}

        def better(into, state, x):
            if state not in into or x[:2] < into[state][:2]:
                into[state] = x

        def inserts(at):
            for _ in range(3):
                for state, (cost, audit, lines) in list(at.items()):
                    role = "a" if state == "u" else "u"
                    better(at, role, (cost + 3, audit + "I", (*lines, {"u": "user:", "a": "assistant:"}[role])))
            return at

        for (_, role, text), fault, initial in zip(held, faults, initials):
            after = {}
            for state, (cost, audit, lines) in inserts(best).items():
                better(after, state, (cost + 4, audit + "D", lines))
                if fault not in ("blank", "duplicate"):
                    more = 3 if fault else 0
                    if (state, initial) in step:
                        better(after, step[state, initial], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                    new = "a" if state == "u" else "u"
                    better(after, new, (cost + more + 3, audit + "R", (*lines, f"{ {'u': 'user', 'a': 'assistant'}[new] }:{text}")))
            best = after
        best = inserts(best)
        cost, audit, lines = min(best[s] for s in ("", "a") if s in best)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out.append((conv, gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def test_repair_against_brute_force(spark):
    rows = conversations()
    want = brute_repair(rows)
    table = spark.createDataFrame(rows, CONVERSATIONS).repartition(4)
    for options in ({}, {"block": 3, "block_bytes": 100}, {"block": 1, "small": 0}):
        same(repair.repair(repair.damage(table), **options).collect(), want)
    assert len({w[7] for w in want}) > 30


def test_one_conversation_is_spread(spark):
    """A conversation of most rows stands in several tasks' blocks, and comes out whole."""
    rows = [(5, t, ("user", "assistant")[t % 2], f"Row {t}.", None) for t in range(2000)] + [(c, 0, "user", "One.", None) for c in range(40)]
    found = repair.repair(repair.damage(spark.createDataFrame(rows, CONVERSATIONS).repartition(4)), block=64)
    same(found.collect(), brute_repair(rows))


def test_repair_of_nothing(spark):
    assert repair.repair(repair.damage(spark.createDataFrame([], CONVERSATIONS))).count() == 0
    gone = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    (row,) = repair.repair(repair.damage(spark.createDataFrame([(1, gone, "user", "Gone.", None)], CONVERSATIONS))).collect()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_search_is_exact_on_small_lattices():
    """A* from every state against all edit sequences."""
    r = random.Random(2)
    for _ in range(60):
        rows = [repair.Row(r.choice(["system", "user", "assistant", "tool", ""]), "x.", r.choice([0, 0, 1, 2, 3])) for _ in range(r.randint(0, 4))]
        for start in range(4):
            every = {}

            def walk(i, state, cost, audit, inserted, rows=rows, every=every):
                if i == len(rows) and (state not in every or (cost, audit) < every[state]):
                    every[state] = (cost, audit)
                target = repair.NEXT[state][0]
                if inserted < 2:
                    walk(i, target, cost + 3, audit + "I", inserted + 1)
                if i < len(rows):
                    walk(i + 1, state, cost + 4, audit + "D", 0)
                    if rows[i].fault not in (1, 2):
                        extra = 3 if rows[i].fault else 0
                        walk(i + 1, target, cost + 3 + extra, audit + "R", 0)
                        kept = repair.STEPS[state].get(rows[i].initial)
                        if kept is not None:
                            walk(i + 1, kept, cost + extra, audit + "K", 0)

            walk(0, start, 0, "", 0)
            assert repair.search(rows, start, whole=False) == every
            if start == repair.EMPTY:
                (only,) = repair.search(rows, start, whole=True).values()
                assert only == min(every[e] for e in repair.ENDS if e in every)


def test_one_empty_row_has_a_place_in_every_result(spark):
    rows = [(1, None, None, None, None), (None, None, None, None, None), (None, None, None, None, None)]
    same(repair.repair(repair.damage(spark.createDataFrame(rows, CONVERSATIONS))).collect(), brute_repair(rows))
