"""Runs at their edges: hot texts, counters that come with a write, all of Unicode, long documents, one-pass files."""

import json
import os
import sys
import unicodedata

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from juriflow.functions import text as T
from juriflow.plans import extract, training
from juriflow.sources import outputs, split_lines

cloudpickle.register_pickle_by_value(sys.modules[__name__])
SCHEMA = "source_row int, processo string, classe string, orgao_julgador string, expediente string, decisao string"


def text(n):
    return f"DESPACHO\n\nIntime-se a parte autora no prazo de {n} dias."


def decisions(spark, texts):
    return spark.createDataFrame([(i + 2, f"P{i}", "Procedimento Comum Cível", "1ª Vara", "Intimação", t) for i, t in enumerate(texts)], SCHEMA)


def plain_fold(s):
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)).casefold()


# ---- folding ----------------------------------------------------------------------------------------------------------


def test_every_code_point_folds(spark):
    """All of Unicode, against NFKD without combining marks, case-folded."""
    points = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    rows = [(k, "|".join(map(chr, points[k : k + 256]))) for k in range(0, len(points), 256)]
    got = {r.k: r.x for r in spark.createDataFrame(rows, "k int, v string").repartition(8).select("k", T.fold(F.col("v")).alias("x")).collect()}
    assert all(got[k] == plain_fold(v) for k, v in rows)


def test_folding_of_texts(spark):
    values = ["Nº 5 № 7", "ﬁm ﬄ ½ ™ ㎏", "한국어 각 가", "각한", "ΑΝΔΡΕΑΣ ﷺ", "𝔄𝕓𝟙 🄰", "ÀÉÎõü ça", "", None, "ASCII only", "ŉ Ǆ ĳ", "áę́", "ệ" * 1000, "각" * 1000]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    assert [r.x for r in df.select("i", T.fold(F.col("v")).alias("x")).orderBy("i").collect()] == [plain_fold(v or "") for v in values]


# ---- hot texts ---------------------------------------------------------------------------------------------------------


def test_a_hot_text_is_split(spark):
    """A text in a third of all rows goes to several tasks; every table is that of a run without any split."""
    texts = [text(1) if i % 3 == 0 else text(2 + i % 40) for i in range(900)] + [""]
    df = decisions(spark, texts).repartition(4)
    keyed = extract._keyed(extract.scope(extract.canonical(df)))
    firsts = extract.first_rows(keyed)
    hot = {r.decision_sha256: r.parts for r in extract.hot_texts(firsts, 40).collect()}
    assert len(hot) == 1 and list(hot.values()) == [8]
    selections = firsts.select("decision_sha256", "first_row")
    met = extract.by_text(keyed.where("state = 'PENDENTE_REVISAO'"), selections, extract.hot_texts(firsts, 40))
    assert met.count() == 900 and met.where("first_row = source_row").count() == firsts.count()
    # the join's key has a part, so that the hot text's rows are dealt to as many tasks
    plain = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}  # as large tables are joined
    was = {k: spark.conf.get(k) for k in plain}
    try:
        for k, v in plain.items():
            spark.conf.set(k, v)
        of = met.where(F.col("decision_sha256") == next(iter(hot))).groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(of) > 1 and max(r["count"] for r in of) < 300
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    for mode in ("rules", "fallback"):
        split, whole = extract.run(df, mode, hot_rows=10), extract.run(df, mode)
        for name in ("documents", "candidates", "errors", "manifest"):
            a, b = (sorted(map(str, getattr(x, name).collect())) for x in (split, whole))
            assert a == b, name


def test_hot_texts_are_few(spark):
    """However many rows there are, at most hot_most texts are hot."""
    firsts = spark.createDataFrame([(f"{i:064d}", i + 2, 50) for i in range(200)], "decision_sha256 string, first_row int, n long")
    assert extract.hot_texts(firsts, 10, 1000).count() == 200
    assert extract.hot_texts(firsts, 10, 100).count() == 0  # each has a 200th of all rows
    assert {r.parts for r in extract.hot_texts(firsts, 10, 1000).collect()} == {5}


def test_a_run_persists_nothing_unless_asked(spark):
    spark.catalog.clearCache()
    run = extract.run(decisions(spark, [text(1), text(2)]))
    run.candidates.collect()
    assert not run.kept and spark.sparkContext._jsc.getPersistentRDDs().size() == 0
    kept = extract.run(decisions(spark, [text(1), text(2)]), keep=True)
    assert kept.candidates.collect() == run.candidates.collect() and len(kept.kept) == 2
    kept.unpersist()


# ---- counters -------------------------------------------------------------------------------------------------------


def test_counters_come_with_the_write(spark, tmp_path):
    df = decisions(spark, [text(1), text(1), "", text(2), "  "])
    for mode in ("rules", "fallback"):
        run = extract.run(df, mode, include_tax=True)
        documents, seen = run.observed()
        documents.write.mode("overwrite").parquet(str(tmp_path / "d"))
        assert seen.get == run.manifest.head().asDict()
        assert sorted(spark.read.parquet(str(tmp_path / "d")).columns) == sorted(run.documents.columns)
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup())
    assert seen.get["scanned"] == 5 and len(jobs.getJobIdsForGroup()) == before  # nothing runs for them
    made = outputs.write_run(run, str(tmp_path / "out"), {}, 0)
    assert (made["scanned"], made["unique_decisions"], made["cache_hits"], made["skipped_empty_decisions"]) == (5, 2, 1, 2)


# ---- passages in long documents ------------------------------------------------------------------------------------


def gold(spark, rows):
    """(id, text, passages) as GOLD documents."""
    made = [(i, [str(i)], f"{i:064d}", f"P{i}", {}, d, [{"text": t, "category": c, "source": "candidate", "validation": "APROVADO"} for t, c in items]) for i, d, items in rows]
    return spark.createDataFrame(made, training.GOLD)


def test_passages_meet_the_units_that_they_overlap(spark):
    source = "\n\n".join(f"Unidade número {k} tem um texto próprio." for k in range(60)) + "\n\nok"
    cuts = [(0, 5), (3, 400), (40, 42), (41, 60), (len(source) - 2, len(source)), (0, len(source)), (39, 41), (200, 230)]
    items = [(source[a:b], "tutela") for a, b in cuts] + [("não está", "tutela"), ("ok", "x"), ("\n\n", "tutela"), ("", "tutela")]
    (row,) = training.mapped(gold(spark, [(7, source, items)])).collect()
    units = [(u.unit_id, u.start, u.end, u.rejected) for u in row.units]
    for (passage, category), s in zip(items, row.spans):
        at = source.find(passage)
        met = [u for u in units if not (u[2] <= at or u[1] >= at + len(passage))]
        reason = "invalid_category" if category == "x" else "gold_not_exact_source" if at < 0 else None if met else "no_units_for_gold"
        assert (s.unit_ids, s.hidden, s.reason) == ([u[0] for u in met], any(u[3] is not None for u in met), reason), passage


def test_first_place(spark):
    df = spark.createDataFrame([([],), ([5],), ([1, 3, 3, 7],), (list(range(1000)),)], "b array<int>")
    for x in (-1, 0, 1, 3, 5, 7, 999, 2000):
        for test, plain in ((f"> {x}", lambda v: v > x), (f">= {x}", lambda v: v >= x)):
            got = df.selectExpr("b", f"{training.first_place('b', test)} AS at").collect()
            assert all(r["at"] == next((i for i, v in enumerate(r.b) if plain(v)), len(r.b)) for r in got)


def test_texts_are_divided_within_their_rows(spark):
    """Mapping gives the units that the list of all units gives, and deals, sorts or numbers no row for it; a review without texts has none in its groups."""
    from juriflow.operators.segment import unit_lists
    from juriflow.plans import review

    long = "Frase comprida de um só bloco. " * 60
    texts = [" \n\n ", "RELATÓRIO\n\nx.\n\n\n \n DECIDO: \n\nA b. C d", f"{long}\n\n Decisão -\n\n  {long}; Mais uma! É isso?   Sim.\n\nDISPOSITIVO", "a. B" * 900, "y" * 1300, "DECIDO\n\n" * 300, "\n\n a"]
    texts.append("\n\n".join(f"linha de número {k}" if k % 50 else ("Dispositivo", "RELATÓRIO")[k % 100 // 50] for k in range(700)))
    df = gold(spark, [(k, t, [(t[-9:], "tutela")]) for k, t in enumerate(texts)])
    mapped = training.mapped(df)
    listed = {r.k: r.units for r in unit_lists(df.selectExpr("source_row AS k", "decision"), ["k"], "decision").collect()}
    assert {r.source_row: r.units for r in mapped.select("source_row", "units").collect()} == {k: listed.get(k, []) for k in range(len(texts))}
    plan = mapped._jdf.queryExecution().optimizedPlan().toString()
    assert not any(node in plan for node in ("Window [", "Generate ", "Join ", "Aggregate ", "Sort "))
    documents = extract.run(decisions(spark, [text(1), text(2), text(1)])).documents
    slim = review.groups(documents.drop("decisao"))
    assert sorted(slim.collect()) == sorted(review.groups(documents).select(*slim.columns).collect()) and "decisao" not in slim.columns


def test_a_document_of_many_units_and_passages(spark):
    """20,000 units and 1,000 passages: time that halving takes, not that of 20 million comparisons."""
    import time

    source = "\n\n".join(f"Unidade {k} com texto." for k in range(20_000))
    items = [(f"Unidade {k * 20} com texto.\n\nUnidade {k * 20 + 1} com", "tutela") for k in range(1000)]
    df = gold(spark, [(7, source, items)])
    training.mapped(df.limit(0)).collect()
    began = time.time()
    (row,) = training.mapped(df).select("spans").collect()
    assert all(s.unit_ids == [f"U{k * 20 + 1:04d}", f"U{k * 20 + 2:04d}"] and s.reason is None for k, s in enumerate(row.spans))
    assert time.time() - began < 60


# ---- files ----------------------------------------------------------------------------------------------------------


def lines(path, name):
    return sorted(x for f in sorted(os.listdir(f"{path}/{name}")) for x in open(f"{path}/{name}/{f}", encoding="utf-8").read().splitlines())


def test_split_lines(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(1000).selectExpr("element_at(array('a', 'b', 'c'), int(1 + id % 3)) AS split", "concat('linha é ', id) AS value").repartition(5)
    counts = split_lines.write(df, path, ("a", "b", "c", "d"), "x_")
    assert counts == {"a": 334, "b": 333, "c": 333, "d": 0} == json.load(open(f"{path}/manifest.json"))
    assert lines(path, "x_b") == sorted(f"linha é {i}" for i in range(1000) if i % 3 == 1) and lines(path, "x_d") == []
    split_lines.write(df.where("split = 'a'"), path, ("a", "b", "c", "d"), "x_")  # what was there goes
    assert len(lines(path, "x_a")) == 334 and lines(path, "x_b") == [] and sorted(os.listdir(path)) == ["manifest.json", "x_a", "x_b", "x_c", "x_d"]


def test_a_failed_write_leaves_what_was_there(spark, tmp_path):
    path = str(tmp_path / "out")
    good = spark.range(100).selectExpr("'a' AS split", "string(id) AS value")
    split_lines.write(good, path, ("a", "b"))
    before = lines(path, "a")
    bad = spark.range(0, 1000, 1, 4).selectExpr("'a' AS split", "CASE WHEN id = 900 THEN raise_error('broken') ELSE string(id) END AS value")
    for df in (bad, good.withColumn("split", F.lit("other"))):
        with pytest.raises(Exception):
            split_lines.write(df, path, ("a", "b"))
        assert lines(path, "a") == before and sorted(os.listdir(path)) == ["a", "b", "manifest.json"]
    with pytest.raises(Exception):
        good.withColumnRenamed("value", "v").write.format("split_lines").options(path=path, splits="a").mode("overwrite").save()


def test_supervised_files_in_one_pass(spark, tmp_path):
    source = "Primeira unidade do texto.\n\nSegunda unidade do texto."
    rows = [(k, source + f"\n\nTexto próprio {k}.", [("Segunda unidade do texto.", "tutela" if k % 5 else "x")]) for k in range(1, 41)]
    mapped = training.mapped(gold(spark, rows))
    counts = training.write(mapped, str(tmp_path))
    assert counts == training.counts(mapped).head().asDict() and counts["issues"] == 8
    for name in ("train", "val", "test"):
        want = [r.value for r in training.examples(mapped).where(F.col("split") == name).select(F.to_json(F.struct("messages", "Processo")).alias("value")).collect()]
        assert lines(str(tmp_path), f"sft_{name}") == sorted(want)
    assert lines(str(tmp_path), "sft_issues") == sorted(r.value for r in training.issues(mapped).select(F.to_json(F.struct("*")).alias("value")).collect())


def test_starts_and_runs_of_white_space(spark):
    """Patterns at a text's start, and what normalize leaves of white space, as Python has them."""
    from juriflow.functions.text import FLAGS, java, normalize, plain, starts
    from juriflow.operators import noise, select

    texts = [" a  b\n\nc  d ", "a b", "\x1c\x1fa\x85b　", "determino. Intime-se", "x determino", "diante do exposto, julgo", "", " ", "julgosa"]
    texts += ["Im pede deferimento e vista", "Requeré a vista dos autos", "x" * 40 + " requer a vista", "Em decisão o juízo determınou a emenda", "Em decisão o juízo deferiu", "1234567890123456", "12345678901234567 x a b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    anchored = [(r, p) for r, p in noise.PATTERNS if p.startswith("^")]
    each = [F.rlike("t", F.lit(FLAGS + java(p))).alias(f"r{k}") for k, (_, p) in enumerate(anchored)]
    cut = [starts(F.col("t"), java(p), FLAGS).alias(f"s{k}") for k, (_, p) in enumerate(anchored)]
    for row in df.select("t", normalize(F.col("t")).alias("n"), F.rlike(normalize(F.col("t")), F.lit(select.OPERATIVE)).alias("o"), select.operative(normalize(F.col("t"))).alias("p"), noise.rejection(F.col("t")).alias("why"), *each, *cut).collect():
        assert row.n == plain(row.t)
        assert row.o == row.p
        assert [row[f"r{k}"] for k in range(len(anchored))] == [row[f"s{k}"] for k in range(len(anchored))]
        if "determ" in row.t and row.t.startswith("Em") or "deferiu" in row.t:
            assert row.why == "historical_reference"
        if row.t.startswith("Requer"):
            assert row.why is None  # a letter follows, as in Python's patterns


def test_additions_do_not_plan_the_review_for_each_part(spark):
    """The keys of gold_additions' union are worked out once: its plan is about that of a review, not eleven of them."""
    from juriflow import queries

    def leaves(name):
        return queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().analyzed().collectLeaves().size()

    assert leaves("gold_additions") < 2 * leaves("gold_items")


def test_hits_are_those_of_documents_without_a_selection(spark):
    given = decisions(spark, [text(1), text(2), text(1), "", text(2), text(1)])
    done = extract.run(given, mode="fallback").selections.where("decision_sha256 = sha2('" + text(2) + "', 256)")
    for known in (None, done):
        run = extract.run(given, mode="fallback", known=known, hot_rows=1)
        want = run.documents.where(F.col("status_documento") == extract.PENDING).select("source_row", "decision_sha256", "cache_hit")
        assert sorted(run.hits.collect()) == sorted(want.collect())
        assert "Window" not in run.hits._jdf.queryExecution().optimizedPlan().toString()  # units are numbered by windows


def test_units_are_judged_without_normalizing_them_whole(spark):
    """Reasons and acts as the whole normalized text gives them, where only what tells is looked at."""
    from juriflow.functions.text import FLAGS, first_of, java, normalize, strip
    from juriflow.operators import noise, select
    from juriflow.operators.segment import units

    acts = ["determino", "Diante do exposto, JULGO", "ante do exposto: expeça-se", "ISTO\tPOSTO;\n homologo", "Por tais fundamentos, rejeito", "ficam as partes intimadas", "fica a parte", "vistas ao autor", "vista à parte"]
    acts += ["Ｄefiro", "défiro", "DEFERİU", "ﬁca as partes intimadas", "determinosa", "Arquivem-se", "cite-se", "1) intime-se", "12.  Proceda", "９. condeno", "9" * 300 + ") acolho", "٣ extingo"]
    ends = ["", " a vista", " x" * 200, " é" * 200, "́" * 150 + " o", " " * 300 + "fim de texto"]
    texts = [lead + act + end for lead in ("", " \n", " ", "x ") for act in acts for end in ends]
    texts += ["Em decisão o juízo DEFERİU a tutela", "Em decisão o juízo determınou", "FULANO DE TAL\nJuiz Federal", "FULANO DE TAL, DATA E HORA REGISTRADAS", "Maceió, na data da assinatura eletrônica.", "a" * 3000 + ", x", "PROCESSO: 1 TURMA julgamento: 1/2/20"]
    texts += ["a b c d e f", "a b c d e f g h i j k l", "é" * 12, "é́" * 11, "ﬃ" * 4, "́" * 40, "....  ........", "Nos termos:", "Determino:", ": x", "\x85", " a  b\x0bc", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    text = F.coalesce("t", F.lit(""))
    n = normalize(text)
    cases = [(strip(text) == "", "empty"), *[(F.rlike(text, F.lit(FLAGS + java(p))), reason) for reason, p in noise.PATTERNS]]
    cases += [(F.endswith(strip(text), F.lit(":")) & ~F.rlike(text, F.lit(FLAGS + java(noise.MAIN_ORDER))), "trailing_colon_fragment"), (F.length(n) < noise.MIN_LENGTH, "too_short")]
    got = df.select("t", noise.rejection(F.col("t")).alias("why"), select.opens(text).alias("act")).collect()
    want = df.select(first_of(cases).alias("why"), F.rlike(n, F.lit(select.OPERATIVE)).alias("act")).collect()
    assert [(r.t, r.why, r.act) for r in got] == [(r.t, w.why, w.act) for r, w in zip(got, want)]
    assert {"historical_reference", "location_date_boilerplate", "signature_or_timestamp", "too_short", None} < {r.why for r in got}
    plan = units(df, ["k"], "t", marks=select.marks("rules"))._jdf.queryExecution().optimizedPlan().toString()
    assert "_n#" not in plan and "_low#" in plan  # the normalized text isn't asked for


def test_rules_find_in_texts_as_they_are_what_normalized_ones_contain(spark):
    """Bits as the whole normalized text gives them; only texts with odd characters are normalized."""
    from juriflow.functions.text import normalize
    from juriflow.operators import rules

    texts = [f"É {p.upper()}." for p in rules.NORMAL] + [p.replace(" ", "  \n") + " — fim" for p in rules.NORMAL] + [p.replace("o", "ó").replace("c", "Ç") for p in rules.NORMAL]
    texts += [p.replace("ss", "ß") for p in rules.NORMAL] + [p[:-1] + "ß" for p in rules.NORMAL] + [p[1:] for p in rules.NORMAL] + [p.replace("a", "á", 1) for p in rules.NORMAL]
    plain = len(texts)
    texts += [p.replace("e", "ｅ", 1) for p in rules.NORMAL] + [p.replace("a", "á") for p in rules.NORMAL] + [p.replace("i", "ĩ") for p in rules.NORMAL] + ["extingo a presente execução, art. ４８７", None, ""]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").withColumn("s", rules.sought(F.col("t"))).withColumn("n", normalize(F.col("t")))
    whole = [F.contains("n", F.lit(p)) for p in rules.NORMAL]
    raw = [place for place, (_, _, _, parts) in enumerate(rules.RULES) if all(kind == "N" for kind, _ in parts)]
    for row in df.select("*", rules.text_bits(F.col("t"), F.col("s")).alias("bits"), F.array(*whole).alias("has")).collect():
        has = dict(zip(rules.NORMAL, row.has))
        for place in raw:
            assert bool(row.bits >> place & 1) == all(has[p] for _, p in rules.RULES[place][3]), (row.t, rules.RULES[place][0])
        assert row.k >= plain or row.s in (None, ""), row.t


def test_texts_are_looked_up_once_even_those_without_units(spark):
    """A run by rules deals each text once, with what is asked of it; a text of headings alone has its row."""
    given = decisions(spark, ["RELATÓRIO\n\nDISPOSITIVO", text(1), "RELATÓRIO\n\n \n\nDefiro o pedido da parte autora."])
    for mode in ("rules", "fallback"):
        run = extract.run(given, mode=mode)
        assert run.selections._jdf.queryExecution().optimizedPlan().toString().count("min_by(") == 1
        rows = run.documents.orderBy("source_row").collect()
        assert rows[0].teacher_recortes_count == 0 and rows[0].teacher_status == ("EMPTY_VALID" if mode == "rules" else "RULE_FALLBACK_EMPTY")
        if mode == "rules":
            picked = run.candidates.where("candidate_rank > 0").select("source_row", "unit_ids", "candidate_text").collect()
            assert (rows[2].source_row, ["U0001"], "Defiro o pedido da parte autora.") in [tuple(p) for p in picked]


def test_rules_pick_openings_without_dealing_units(spark):
    """A run by rules takes the units that the list of all units gives, and needs no row, window or group of units for that."""
    from juriflow.operators import select
    from juriflow.operators.segment import unit_lists, unit_texts

    acts = ["Defiro o pedido da parte autora.", "Intimem-se as partes, com urgência.", "Determino:", "EXPEÇA-SE o ofício requisitório.", "Em decisão anterior, o juízo deferiu.", "Cite-se.", "É o caso.", "a) juros", "12) Proceda a contadoria.", "Intimem-se."]
    heads = ["RELATÓRIO", " :- decisão -: ", " Dispositivo:", "dısposıtıvo", "DECIDO que sim, defiro", "relatorio" + " " * 300, "-: DESPACHO"]
    texts = ["\n\n".join([head, *acts[k:], "  x ", " y　", "\x85"]) for head in heads for k in range(len(acts))]
    texts += [gap.join(acts * 3) for gap in ("\n \n", "\n \n\n", " \n\n ", "\n\n\n\nDECIDO\n\n", "\n")] + [" ".join([*acts, "É o que se tem."] * 9), "\n\n" + " ".join(acts * 9) + "\n\n" + acts[0], "RELATÓRIO", "x", "\n\n. \n\n"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, decisao string")
    lists = unit_lists(df, ["k"], marks=select.marks("rules"), every=True)
    listed = {r.k: r for r in lists.select("k", F.transform(F.filter("units", lambda u: u["text"] != ""), lambda u: u["text"]).alias("t"), select.opening_items(F.col("marked")).alias("p")).collect()}
    for row in df.select("k", unit_texts(F.col("decisao")).alias("t"), select.opened_items(select.first_openings(unit_texts(F.col("decisao")), 3)).alias("p")).collect():
        assert (row.t, row.p) == (listed[row.k].t, listed[row.k].p), texts[row.k]
    run = extract.run(decisions(spark, texts))
    plan = run.selections._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" not in plan and "Generate " not in plan
    picked = {(r.source_row - 2, tuple(r.unit_ids)) for r in run.candidates.where("candidate_rank > 0").collect()}
    assert len(picked) > len(texts) and picked == {(k, tuple(p.unit_ids)) for k, r in listed.items() for p in r.p}


def test_slots_come_from_texts_not_from_rows(spark):
    """The review's slots are those of all rows' candidates, with earlier selections too, but no row is joined for them."""
    from juriflow.plans import review

    given = decisions(spark, [text(1), text(2), text(1), "RELATÓRIO", text(3), text(2)])
    earlier = extract.run(decisions(spark, [text(2), text(9)])).selections
    for known in (None, earlier):
        run = extract.run(given, known=known)
        assert sorted(review.slots(run.proposals).collect()) == sorted(review.slots(run.candidates).collect()) != []
    assert "Join" not in extract.run(given).proposals._jdf.queryExecution().optimizedPlan().toString()
