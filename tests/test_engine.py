"""Behaviour of the extraction engine on small inputs."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from plain_answers import plain
from juriflow.functions import text as T
from juriflow.operators import noise, rules, segment, select, teacher
from juriflow.operators.router import route
from juriflow.plans import extract, gold, review, training
from juriflow.sources import outputs, xlsx

cloudpickle.register_pickle_by_value(sys.modules[__name__])
HEADER = ["Processo", "Classe", "Origem", "Órgão Julgador", "Expediente", "Assunto", "Seção/Subseção", "Decisão Judicial", "Núcleo"]


def text(n):
    return f"DESPACHO\n\nIntime-se a parte autora no prazo de {n} dias."


def decisions(spark, texts, notice="Intimação"):
    rows = [(i + 2, f"P{i}", "Procedimento Comum Cível", "1ª Vara", notice, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "source_row int, processo string, classe string, orgao_julgador string, expediente string, decisao string")


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_text_functions_equal_a_plain_restatement(spark):
    values = ["1ª Vara  Federal\tAL", "STRASSE straße", "ação Ñandú", None, "", " \x1c x ", "ÉÇÃO ﬁm…", "½ N.º 7"]
    assert column(spark, values, T.normalize) == [plain(v) for v in values]
    assert column(spark, ["1ª Vara Federal AL", "---", None, "a" * 90], T.slug) == ["1a_vara_federal_al", "na", "na", "a" * 80]


def test_families_and_scope(spark):
    got = column(spark, ["Mandado de Segurança Cível", "Cumprimento de Sentença", "CumSenFaz", None, "Embargos à Execução Fiscal", "AGRAVO"], T.class_family)
    assert got == ["mandado_seguranca", "cumprimento_sentenca", "cumsenfaz", "na", "execucao_fiscal", "agravo"]


def test_noise_reasons(spark):
    cases = {
        "No mérito, requer a total procedência da ação": "likely_party_request",
        "25111006294315100000147581491": "numeric_identifier_only",
        "Prazo para impugnação: 05 (cinco) dias.": "orphan_deadline",
        "Assinado eletronicamente por FULANO DE TAL\n20/01/2026 13:10:46": "signature_or_timestamp",
        "Intimações e providências necessárias.": "generic_closing_fragment",
        "9. Intimações e providências necessárias.": "generic_closing_fragment",
        "3. Intimem-se.": "generic_closing_fragment",
        "Arapiraca-AL, data e hora registradas no sistema.": "location_date_boilerplate",
        "DETERMINO que a contadoria faça os cálculos, devendo considerar:": None,
        "  \n": "empty",
        "https://x.example/a 251110062943": "url_or_electronic_identifier",
        "Em despacho anterior o juízo determinou a emenda": "historical_reference",
        "PROCESSO: 08 RELATOR: X JULGAMENTO: 01/02/2020": "external_case_citation",
        "Nos seguintes e demorados termos:": "trailing_colon_fragment",
        "É o caso.": "too_short",
        "Fulano da Silva Sauro\nJuiz Federal": "signature_or_timestamp",
    }
    assert column(spark, list(cases), noise.rejection) == list(cases.values())


def test_rules_first_match_wins(spark):
    rows = [
        ("O presente processo foi migrado para este sistema eletrônico", "Sentença"), ("texto qualquer", "Sentença"), ("texto", "Intimação para Contrarrazões"),
        ("Resolução 689/2026", "Sentença"), ("SENTENÇA\nResolução 689/2026", "x"), ("Resolução 689/2026", "x"), ("SENTENÇA \n x", "x"), ("ATO ORDINATÓRIO\n", ""), ("nada", None),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, d string, e string")
    got = [r.x for r in df.select("i", rules.classify(F.col("d"), F.col("e"))["rule_id"].alias("x")).orderBy("i").collect()]
    assert got == ["J01", "J13", "J15", "J09", "J10", "J11", "J18", "J19", None]


def test_router(spark):
    df = spark.createDataFrame([("Mandado de Segurança", "1ª Vara", "Maceió"), (None, None, None)], "classe string, orgao_julgador string, secao_subsecao string")
    got = [(r.route_key, r.specialist) for r in route(df).collect()]
    assert got == [("mandado_seguranca|maceio|1a_vara", "ms_specialist"), ("na|na|na", "global_teacher")]


def plain_units(source):
    """Segmentation restated over one string."""
    import re

    out, section, at = [], segment.FIRST_SECTION, 0
    spans = []
    for m in re.finditer(r"\n\s*\n+", source):
        spans.append((at, m.start()))
        at = m.end()
    spans.append((at, len(source)))
    for a, b in spans:
        head = segment.SECTIONS.get(source[a:b].strip().upper().strip(" :-"))
        if head:
            section = head
            continue
        cuts = [a, *[a + m.start() for m in re.finditer(r"(?<=[.!?;])\s+(?=[A-ZÁÉÍÓÚÂÊÔÃÕÇ])", source[a:b])], b] if b - a > segment.LONG else [a, b]
        for x, y in zip(cuts, cuts[1:]):
            piece = source[x:y]
            if piece.strip():
                start = x + len(piece) - len(piece.lstrip())
                out.append((f"U{len(out) + 1:04d}", start, start + len(piece.strip()), piece.strip(), section))
    return out


def test_segmentation_offsets(spark):
    texts = [
        "RELATÓRIO\n\nTrata-se de ação.\n\nDISPOSITIVO:\n\nIntime-se a União.", "\n\n  a b  \n \n\nDECIDO\n\nx", "só um", "", "  ",
        "Uma frase longa. " * 100 + "É outra! Sim; Não.\r\n\r\nFim", "a\n\n\n\nb\n\t\nc",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, decisao string")
    got = {}
    for r in segment.units(df, ["k"]).orderBy("k", "start").collect():
        got.setdefault(r.k, []).append((r.unit_id, r.start, r.end, r.text, r.section))
        assert texts[r.k][r.start : r.end] == r.text
    assert got == {k: u for k, t in enumerate(texts) if (u := plain_units(t))}


def test_reconstruction(spark):
    source = "Primeira ordem aqui.\n\nDECIDO\n\nSegunda ordem.\n\nUm trecho no meio.\n\nTerceira ordem."
    df = segment.unit_lists(spark.createDataFrame([(1, source)], "k int, decisao string"), ["k"]).withColumn("decisao", F.lit(source))
    for ids, want in (
        (["U0002"], "Segunda ordem."), (["U0002", "U0001"], "Primeira ordem aqui.\nSegunda ordem."), (["U0003", "U0004"], "Um trecho no meio.\n\nTerceira ordem."), (["U0002", "U0004"], "Segunda ordem.\nTerceira ordem."), (["U9"], ""),
    ):
        got = df.withColumn("ids", F.array(*map(F.lit, ids))).select(segment.reconstruct("decisao", "ids", "units")).head()[0]
        assert got == want


def canned(*replies):
    replies = list(replies)

    def post(body):
        reply = replies.pop(0) if len(replies) > 1 else replies[0]
        if isinstance(reply, Exception):
            raise reply
        return reply

    return post


def test_cache_and_unique_limit(spark):
    reply = (200, json.dumps({"choices": [{"message": {"content": '{"selected":[{"unit_ids":["U0002"],"category":"intimacao_manifestacao"}]}'}}]}))
    asked = teacher.teacher(lambda: canned(reply), teacher.Endpoint("x", "m", 1, 1))
    run = extract.run(decisions(spark, [text(1), text(1)]), "llama", teacher=asked)
    m = run.manifest.head()
    assert (m.processed, m.errors, m.unique_inferences, m.cache_hits) == (2, 0, 1, 1)
    assert {r.candidate_text for r in run.candidates.collect()} == {"Intime-se a parte autora no prazo de 1 dias."}
    run = extract.run(decisions(spark, [text(1), text(1), text(2), text(3)]), "fallback", unique_limit=2)
    m = run.manifest.head()
    assert (m.scanned, m.processed, m.unique_decisions, m.cache_hits) == (3, 3, 2, 1)
    assert review.build(run.documents, run.candidates).count() == 2


def test_limits_and_empty_runs(spark):
    df = decisions(spark, [text(1), "", text(2)])
    for options, want in (({"limit": 0}, 0), ({"unique_limit": 0}, 0), ({"start": 1, "limit": 1}, 1), ({}, 3)):
        assert extract.run(df, **options).manifest.head().scanned == want
    with pytest.raises(ValueError):
        extract.run(df, "other")


def test_review_gold_and_training(spark):
    run = extract.run(decisions(spark, [text(1), text(1), text(2)]))
    built = review.build(run.documents, run.candidates, n=3)
    first = built.orderBy("first_row").head()
    assert (built.count(), first.occurrences, first.slots[0].text, first.slots[0].state, first.source_rows) == (2, 2, "Intime-se a parte autora no prazo de 1 dias.", "PENDENTE", "2, 3")

    def revised(state, done="VALIDADO_COMPLETO", edited="", absent=""):
        rows = [(first.key, 1, [(1, edited, "", "", "", state)], [(absent, "obrigacao")], done, "r", "")]
        return review.build(run.documents, run.candidates, earlier(rows), n=3)

    def earlier(rows):
        schema = "key string, place int, slots array<struct<rank:int,text:string,category:string,adjusted_text:string,adjusted_category:string,state:string>>, missing array<struct<text:string,category:string>>, state string, reviewer string, note string"
        return spark.createDataFrame(rows, schema)

    judged = gold.judge(revised("AJUSTADO", edited="Intime-se a parte autora"))
    doc = gold.records(judged).head()
    assert [(g.text, g.validation) for g in doc.gold] == [("Intime-se a parte autora", "AJUSTADO")] and gold.metrics(judged).head().blocked_documents == 0
    blocked = gold.judge(revised("PENDENTE"))
    assert gold.records(blocked).count() == 0 and "ainda não revisado" in gold.issues(blocked).head().issues
    assert review.alert(revised("PENDENTE")).where("complete_with_pending").count() == 1
    more = spark.createDataFrame([("", "D0001", "no prazo de 1 dias.", "prazo_cumprimento", 2), (first.key, "", "DESPACHO", "obrigacao", 3)], "sha string, id string, text string, category string, place int")
    full = gold.records(gold.judge(revised("APROVADO", absent="Intime-se"), more)).head()
    assert [g.text for g in full.gold] == ["Intime-se a parte autora no prazo de 1 dias.", "Intime-se", "DESPACHO", "no prazo de 1 dias."]
    assert review.metrics(revised("APROVADO")).head().strict_precision == 1.0
    mapped = training.mapped(gold.records(judged))
    example = training.examples(mapped).head()
    assert json.loads(example.messages[2].content) == {"selected": [{"unit_ids": ["U0002"], "category": "intimacao_manifestacao"}]}
    assert sum(training.counts(mapped).head()[:3]) == 1 and training.issues(mapped).count() == 0


def test_workbooks(spark, tmp_path):
    path = str(tmp_path / "in.xlsx")
    rows = [["P1", "Procedimento Comum", "x", "1ª Vara", "Intimação", "a", "Maceió", text(1), "n"], ["P2", "Execução Fiscal", "x", "1ª Vara", "y", "a", "s", text(2), None]]
    xlsx.write(path, {"dados": (HEADER, iter(rows))})
    table = xlsx.read_table(spark, path)
    assert [(r.source_row, r.processo, r.nucleo) for r in table.collect()] == [(2, "P1", "n"), (3, "P2", None)]
    out = str(tmp_path / "out")
    made = outputs.write_run(extract.run(table), out, {}, 0)
    assert (made["scanned"], made["processed"]) == (2, 1) and list(xlsx.Workbook(f"{out}/review.xlsx").sheets)[0] == "revisao"
    again = outputs.rebuild_review(spark, f"{out}/review.xlsx", str(tmp_path / "again.xlsx"))
    assert again["decisions"] == 2 and not again["model_rerun"]
    got = outputs.build_gold(spark, f"{out}/review.xlsx", str(tmp_path / "gold.jsonl"))
    assert got["validated_documents"] == 0 and got["source"] == "revisao"
    with pytest.raises(KeyError):
        list(xlsx.Workbook(path).rows("other"))
    with pytest.raises(ValueError):
        xlsx.resolve(["Processo"])


def test_score_prefers_acts_to_narrative(spark):
    df = spark.createDataFrame([("julgo procedente",), ("sustenta que julgo",), ("a parte foi devidamente notificada",)], "t string")
    got = [r[0] for r in df.select(select.fallback_score(F.col("t"), F.lit("sentenca"))).collect()]
    assert got == [12, 0, 0]


def test_registry_without_the_corpus_operators():
    import __spark_entry__ as entry

    assert len(entry.queries()) >= 20 and set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_end_words_as_their_sql_does(spark, tmp_path):
    """Where an accented letter follows a pattern's word the queries give what their SQL gives, and the engine by itself what Python's patterns give."""
    import duckdb

    from juriflow import queries

    told = "Em decisão anterior, o juízo {} a emenda da inicial."
    words = ["REQUERÉ!! ÈÈEUXÇ!! ÈIER!!", "Requeré les re antion.", "Requer a procedência.", "pedeſ mais um prazo", "pedeK mais um prazo", "pedeı mais um prazo", "REQUERÉ!!", "éem decisão o juízo determinou tudo",
             told.format("determinoué"), told.format("determinou"), "Determinoé o que segue:", "Determino o que segue:", "Assinado eletronicamente poré FULANO", "requer_se a procedência"]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    got = df.select("t", noise.rejection(F.col("t")).alias("own"), noise.rejection(F.col("t"), ascii_words=True).alias("sql")).collect()
    want = {w: duckdb.execute(f"SELECT {queries.sql_rejection('t', 't')} FROM (SELECT ? AS t)", [w]).fetchone()[0] for w in words}
    assert {r.t: r.sql for r in got} == want
    assert {r.t: r.own for r in got}[words[0]] is None and want[words[0]] == "likely_party_request"
    docs = spark.createDataFrame([(k, w, "pt", None, len(w)) for k, w in enumerate(words)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    made = duckdb.connect()
    made.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    for name in ("seg_units", "filters_reason"):
        rows = queries.QUERIES[name](spark, str(tmp_path)).collect()
        assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, made.execute(queries.ORACLE[name]).fetchall())), name


def test_the_first_units_of_a_missing_passage_are_judged_as_in_sql(spark, tmp_path):
    """sft_map: a passage that isn't in its text meets the first units, which are hidden where an accented letter follows a pattern's word."""
    import duckdb

    from juriflow import queries

    docs = spark.createDataFrame([(k, f"REQUERÉ!! número {k}", "pt", None, 7) for k in range(60)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    made = duckdb.connect()
    made.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = made.execute(queries.ORACLE["sft_map"]).fetchall()
    rows = queries.QUERIES["sft_map"](spark, str(tmp_path)).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want)) and any(r[4] == "gold_not_exact_source" and r[5] for r in want)
