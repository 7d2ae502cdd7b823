"""What stands at the engine's edges: workbooks to fill in, older layouts, the command line, streams with a restart."""

import json
import os
import re
import sys
import zipfile

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from juriflow import cli
from juriflow.functions import text as T
from juriflow.functions.constants import CATEGORIES
from juriflow.operators import noise, router, rules, select, teacher
from juriflow.plans import extract, gold, review, training
from juriflow.sources import outputs, xlsx
from juriflow.streaming import runs

cloudpickle.register_pickle_by_value(sys.modules[__name__])
HEADER = ["Processo", "Classe", "Origem", "Órgão Julgador", "Expediente", "Assunto", "Seção/Subseção", "Decisão Judicial", "Núcleo"]


def text(n):
    return f"DESPACHO\n\nIntime-se a parte autora no prazo de {n} dias."


def workbook(path, n=3):
    rows = [[f"P{i}", "Procedimento Comum", "x", "1ª Vara", "Intimação", "a", "Maceió", text(1 + i // 2), "n"] for i in range(n)]
    xlsx.write(path, {"dados": (HEADER, iter(rows))})
    return path


def decisions(spark, texts):
    rows = [(i + 2, f"P{i}", "Procedimento Comum Cível", "1ª Vara", "Intimação", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "source_row int, processo string, classe string, orgao_julgador string, expediente string, decisao string")


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_review_workbook_recounts_itself(spark, tmp_path):
    """Formulas and validations, read back; and the formulas worked out over a filled-in sheet give review.metrics."""
    out = str(tmp_path / "out")
    outputs.write_run(extract.run(xlsx.read_table(spark, workbook(str(tmp_path / "in.xlsx")))), out, {}, 0)
    path = f"{out}/review.xlsx"
    book = xlsx.Workbook(path)
    with zipfile.ZipFile(path) as z:
        part = {n: z.read(f"xl/worksheets/sheet{i}.xml").decode() for i, n in enumerate(book.sheets, 1)}
        assert z.read("xl/styles.xml").count(b"<dxf>") == 4
    formulas = dict(re.findall(r'<t xml:space="preserve">(\w+)</t></is></c><c r="B\d+"[^>]*><f>([^<]*)</f>', part["metricas"]))
    assert set(formulas) == {
        "unique_decisions", "complete", "proposed", "approved", "adjusted", "rejected", "pending", "additions", "complete_without_additions",
        "strict_precision", "useful_rate", "recall", "complete_coverage", "f1",
    }
    head = next(book.rows("revisao"))
    at = {h: xlsx.column_name(i) for i, h in enumerate(head)}
    v = at["Validação 1"]
    assert formulas["approved"] == "+".join(f"COUNTIF('revisao'!${c}$2:${c}$3,\"APROVADO\")" for c in (at[f"Validação {i}"] for i in (1, 2, 3)))
    assert formulas["strict_precision"] == "IFERROR(B5/(B5+B6+B7),\"\")" and formulas["f1"] == "IFERROR(2*B11*B13/(B11+B13),\"\")"
    lists = dict(re.findall(r'sqref="([^"]+)"><formula1>([^<]+)</formula1>', part["revisao"]))
    assert lists[f"{v}2:{v}3"] == "listas!$A$2:$A$5" and lists[f"{at['Categoria 1']}2:{at['Categoria 1']}3"] == f"listas!$B$2:$B${len(CATEGORIES) + 1}"
    assert lists[f"{at['Status da decisão']}2:{at['Status da decisão']}3"] == "listas!$C$2:$C$3" and len(lists) == 9
    assert part["revisao"].count("<cfRule") == 14 and "listas!$B$2" in part["adicoes_gold"]
    shown = {r[0]: r[1] for r in list(book.rows("metricas"))[1:]}
    assert shown["unique_decisions"] == 2 and shown["pending"] == 2 and shown["f1"] in (None, "")
    assert list(book.rows("listas"))[1][:3] == ["PENDENTE", CATEGORIES[0], "PENDENTE_REVISAO"]


def test_numbers_of_decisions_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(review, "BLOCK", 2)
    run = extract.run(decisions(spark, [text(i // 2) for i in range(11)]))
    got = [(r.id, r.first_row) for r in review.groups(run.documents).orderBy("first_row").collect()]
    assert got == [(f"D{i + 1:04d}", 2 + 2 * i) for i in range(6)]


def test_f1_is_of_the_strict_precision(spark):
    slot = "array<struct<text:string,state:string>>"
    rows = [([("a", "APROVADO"), ("b", "AJUSTADO")], [("c",)], "VALIDADO_COMPLETO"), ([("d", "REJEITADO"), ("", "")], [("",)], "VALIDADO_COMPLETO")]
    m = review.metrics(spark.createDataFrame(rows, f"slots {slot}, missing array<struct<text:string>>, state string")).head()
    p, r = 1 / 3, 2 / 3
    assert (round(m.strict_precision, 9), round(m.useful_rate, 9), round(m.recall, 9)) == (round(p, 9), round(2 / 3, 9), round(r, 9))
    assert abs(m.f1 - 2 * p * r / (p + r)) < 1e-12 and m.complete_coverage == 0.5


def test_older_layouts(spark):
    sheet = spark.createDataFrame(
        [("validado_completo ", "5, 7", "h", "P", "x", "Texto.", "tutela", "APROVADO", "", "", "b", "prazo_cumprimento", "AJUSTADO", "b2", "", " mais ", ""),
         ("PENDENTE", "6", "h", "P", "x", "t", "tutela", "APROVADO", "", "", "", "", "", "", "", "", "")],
        "status_documento string, source_rows string, decision_sha256 string, Processo string, decisao string, candidate_1_text string, candidate_1_category string, candidate_1_status string, "
        "candidate_1_texto_ajustado string, candidate_1_categoria_ajustada string, candidate_2_text string, candidate_2_category string, candidate_2_status string, candidate_2_texto_ajustado string, "
        "candidate_2_categoria_ajustada string, adicao_1_text string, adicao_1_category string",
    )
    [r] = gold.consolidated(sheet, 2).collect()
    assert (r.source_row, r.source_rows) == (5, ["5", "7"])
    assert [tuple(g) for g in r.gold] == [("Texto.", "tutela", "candidate"), ("b2", "prazo_cumprimento", "candidate"), ("mais", "outro_acionavel", "human_addition")]
    done = spark.createDataFrame([("3", "P3", "d3", "VALIDADO_COMPLETO"), ("4", "P4", "d4", "x")], "source_row string, processo string, decisao string, status_documento string")
    some = spark.createDataFrame(
        [("3", "a", "tutela", "APROVADO", "", "", 2), ("3", "b", "tutela", "REJEITADO", "", "", 3), ("?", "c", "tutela", "APROVADO", "", "", 4), ("4", "d", "tutela", "APROVADO", "", "", 5)],
        "source_row string, candidate_text string, teacher_category string, status_validacao string, texto_ajustado string, categoria_ajustada string, place int",
    )
    more = spark.createDataFrame([("3", "e", "", 2), ("3", " ", "", 3)], "source_row string, texto_gold string, categoria_gold string, place int")
    [r] = gold.from_long(done, some, more).collect()
    assert (r.source_row, r.Processo, r.decision) == (3, "P3", "d3")
    assert [tuple(g) for g in r.gold] == [("a", "tutela", "candidate"), ("e", "outro_acionavel", "human_addition")]


def test_gold_lines(spark, tmp_path):
    good = {"source_row": 1, "source_rows": ["1"], "decision_sha256": "h", "Processo": "P", "metadata": {"classe": "c", "other": 1}, "decision": text(1), "gold": [{"text": "Intime-se a parte autora no prazo de 1 dias.", "category": "tutela"}]}
    path = tmp_path / "gold.jsonl"
    path.write_text(json.dumps(good) + "\n\n")
    [r] = training.read_gold(spark, str(path)).collect()
    assert r.metadata.classe == "c" and json.loads(r.metadata_json)["other"] == 1
    mapped = training.mapped(training.read_gold(spark, str(path)))
    training.write(mapped, str(tmp_path / "sft"))
    written = [json.loads(x.value) for n in ("train", "val", "test") for x in spark.read.text(str(tmp_path / "sft" / f"sft_{n}")).collect()]
    assert [m["role"] for m in written[0]["messages"]] == ["system", "user", "assistant"] and len(written) == 1
    path.write_text(json.dumps(good) + '\n{"decision": broken\n')
    with pytest.raises(Exception, match="not a GOLD document"):
        training.read_gold(spark, str(path)).collect()


def test_a_text_without_units_has_no_hidden_ones(spark):
    rows = [(2, ["2"], "h", "P", None, "", [("x", "tutela", "candidate", "APROVADO")])]
    spans = training.mapped(spark.createDataFrame(rows, training.GOLD)).head().spans
    assert (spans[0].unit_ids, spans[0].hidden, spans[0].reason) == ([], False, "gold_not_exact_source")


def test_command_line(spark, tmp_path, capsys):
    path = workbook(str(tmp_path / "in.xlsx"), 4)
    found = cli.main(["inspect", "--input", path, "--limit", "3"], spark)
    assert found["rows"] == 3 and found["top_classes"] == [["Procedimento Comum", 3]]
    out = str(tmp_path / "run")
    made = cli.main(["run", "--input", path, "--output", out, "--teacher", "rules", "--unique-limit", "1"], spark)
    assert (made["scanned"], made["processed"], made["unique_decisions"]) == (1, 1, 1)
    assert json.load(open(f"{out}/manifest.json"))["unique_limit"] == 1 and os.path.isdir(f"{out}/predictions.jsonl")
    again = cli.main(["rebuild-review", "--review", f"{out}/review.xlsx", "--output", str(tmp_path / "again.xlsx")], spark)
    assert again["decisions"] == 1 and list(xlsx.Workbook(str(tmp_path / "again.xlsx")).sheets) == list(xlsx.Workbook(f"{out}/review.xlsx").sheets)
    assert cli.main(["build-gold", "--review", str(tmp_path / "again.xlsx"), "--output", str(tmp_path / "gold.jsonl")], spark)["validated_documents"] == 0
    os.makedirs(tmp_path / "sft")
    (tmp_path / "g.jsonl").write_text(json.dumps({"decision": text(1), "Processo": "P", "gold": [], "metadata": {}, "source_row": 2}) + "\n")
    assert sum(cli.main(["build-sft", "--gold", str(tmp_path / "g.jsonl"), "--outdir", str(tmp_path / "sft")], spark)[k] for k in ("train", "val", "test")) == 1
    capsys.readouterr()


def test_tables_of_other_kinds(spark, tmp_path):
    head = "Processo,Classe,Órgão Julgador,Expediente,Decisão Judicial\n"
    (tmp_path / "in.csv").write_text(head + "".join(f'P{i},c,o,e,"d ""{i}"""\n' for i in range(5)))
    got = [(r.source_row, r.processo, r.decisao) for r in xlsx.read_table(spark, str(tmp_path / "in.csv")).orderBy("source_row").collect()]
    assert got == [(i + 2, f"P{i}", f'd "{i}"') for i in range(5)]
    rows = [{"source_row": 9, "processo": "P", "classe": "c", "orgao_julgador": "o", "expediente": "e", "decisao": "d"}]
    (tmp_path / "in.jsonl").write_text("\n".join(map(json.dumps, rows)))
    assert [r.source_row for r in xlsx.read_table(spark, str(tmp_path / "in.jsonl")).collect()] == [9]


def test_profiles(spark, tmp_path):
    path = tmp_path / "profiles.json"
    path.write_text(json.dumps({"profiles": [{"class_family": "agravo", "specialist": "own"}]}))
    assert router.load_profiles(str(path)) == ({"class_family": "agravo", "specialist": "own"},)
    assert router.load_profiles(str(tmp_path / "none.json")) == ()


def test_streams_remember_selections(spark, tmp_path):
    """Texts of earlier batches aren't asked for again, also after a restart; the unique limit is the stream's."""
    arriving, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    schema = "source_row int, processo string, classe string, orgao_julgador string, expediente string, decisao string"

    def arrive(name, rows):
        spark.createDataFrame([(i, f"P{i}", "c", "o", "e", t) for i, t in rows], schema).coalesce(1).write.json(f"{arriving}/{name}")

    def go(**options):
        runs.start(spark.readStream.schema(schema).json(f"{arriving}/*"), out, checkpoint, mode="fallback", **options).awaitTermination()

    arrive("a", [(2, text(1)), (3, text(1)), (4, text(2))])
    go()
    arrive("b", [(5, text(2)), (6, text(3)), (7, text(3))])
    go()
    documents = {r.source_row: r.cache_hit for r in runs.results(spark, out)[1].collect()}
    assert documents == {2: False, 3: True, 4: False, 5: True, 6: False, 7: True}
    assert {r.source_row for r in runs.results(spark, out)[0].collect()} == set(documents)
    assert runs.selections(spark, out, 1).count() == 2 and runs.selections(spark, out, 2).count() == 3
    arrive("c", [(8, text(1)), (9, text(4)), (10, text(5))])
    go(unique_limit=4)
    assert {r.source_row for r in runs.results(spark, out)[1].where("source_row > 7").collect()} == {8, 9}


def test_answers_are_written_once(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()
    reply = (200, json.dumps({"choices": [{"message": {"content": '{"selected":[{"unit_ids":["U0002"],"category":"tutela"}]}'}}]}))

    def make_post():
        def post(body):
            (asked / str(len(list(asked.iterdir())))).write_text("")
            return reply

        return post

    for folder in (str(tmp_path / "answers"), None):
        ask = teacher.teacher(make_post, teacher.Endpoint("x", "m", 1, 0), folder=folder)
        run = extract.run(decisions(spark, [text(1), text(2)]), "llama", teacher=ask)
        run.unpersist()
        assert run.candidates.count() == 2 and run.candidates.count() == 2
    assert len(list(asked.iterdir())) == 4


# Literal expectations for every entry of the fixed tables, so that the SQL built from the same tables isn't its own witness.
RULE_EXAMPLES = (
    ("J01", "O presente PROCESSO foi migrado para este sistema eletrônico.", ""), ("J02", "Finalidade: intimar as partes acerca do sobrestamento do processo", ""),
    ("J03", "manifestarem-se sobre a ocorrência de prescrição intercorrente", ""), ("J04", "Intime-se a credora para se manifestar sobre a EPE", ""),
    ("J05", "EXTINGO a presente execução (art. 487)", ""), ("J06", "ação ajuizada em duplicidade", ""), ("J07", "determino a transformação em pagamento definitivo", ""),
    ("J08", "acolho a exceção de pré-executividade", ""), ("J09", "Resolução 689/2026", "Sentença"), ("J10", "SENTENÇA\n689/2026", ""), ("J11", "689/2026", ""), ("J12", "x", "Citação"),
    ("J13", "x", "SENTENÇA"), ("J14", "x", "Intimação do Requisitório"), ("J15", "x", "Intimação para contrarrazões"),
    ("J16", "Intimo a(s) parte(s) apelada(s) para apresentar(em) contrarrazões", ""), ("J17", "Manifeste-se acerca do(s) novo(s) documento(s) juntado(s) aos autos", ""),
    ("J18", "SENTENÇA\x1c\n x", ""), ("J19", "ATO ORDINATÓRIO\nx", ""),
)


def test_every_rule(spark):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(RULE_EXAMPLES)], "i int, id string, d string, e string")
    got = [(r.id, r.x) for r in df.select("i", "id", rules.classify(F.col("d"), F.col("e"))["rule_id"].alias("x")).orderBy("i").collect()]
    assert got == [(r[0], r[0]) for r in RULE_EXAMPLES] and len(got) == len(rules.RULES)


def test_categories_and_openings(spark):
    cases = {
        "julgo procedente": "resultado_julgamento", "condeno em honorarios": "honorarios_custas", "ocorreu a decadencia": "prescricao_decadencia", "notifique-se": "intimacao_manifestacao",
        "intime-se": "intimacao_manifestacao", "remeta-se ao juizo": "recurso_proximo_passo", "expeca-se rpv": "restituicao_pagamento", "nada": "ordem_determinacao",
    }
    assert dict(zip(cases, column(spark, list(cases), select.category))) == cases
    acts = ["3. intime-se a uniao", "diante do exposto, defiro", "vista ao mp", "ficam as partes intimadas", "a parte alega", "intimou-se"]
    assert column(spark, acts, select.operative) == [True, True, True, True, False, False]


def test_noise_sees_all_white_space(spark):
    assert column(spark, ["\x1c25111006294315100000\x1f", "\x1d\x1e"], noise.rejection) == ["numeric_identifier_only", "empty"]
