"""What a run writes: JSON lines, the manifest, the review workbook; and reading a reviewed workbook back."""

from __future__ import annotations

import csv
import json
import os
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from juriflow.functions.constants import CATEGORIES, DOCUMENT_STATES, SLOT_STATES
from juriflow.plans import gold, review
from juriflow.plans.extract import Run
from juriflow.sources import xlsx

VERSION = "1.0"
# The steps of a revision.
STEPS = (
    ("PASSO", "O QUE FAZER"),
    ("1", "Leia a decisão integral em 'leitura_decisoes'."),
    ("2", "Em 'revisao', marque cada recorte como APROVADO, AJUSTADO ou REJEITADO."),
    ("3", "Se AJUSTADO, edite o texto ou a categoria no próprio recorte."),
    ("4", "Acrescente trechos que faltam em 'Recorte ausente' ou, além de dois, em 'adicoes_gold'."),
    ("5", "Só então marque a decisão como VALIDADO_COMPLETO."),
    ("6", "Não altere as abas ocultas."),
)
ADDITIONS = ["ID", "decision_sha256", "Processo", "texto_gold", "categoria_gold", "observacao", "revisor", "revisado_em"]
HIDDEN = ("dados_tecnicos", "candidatos_tecnicos", "listas")


def json_lines(df: DataFrame, path: str, order: list[str]) -> None:
    """A folder of JSON lines in order; empty tables give an empty folder of files."""
    df.orderBy(*order).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def predictions(candidates: DataFrame) -> DataFrame:
    """Candidates as they are exported: ids as JSON text with Python's separators."""
    ids = F.concat(F.lit("["), F.array_join(F.transform("unit_ids", lambda x: F.concat(F.lit('"'), x, F.lit('"'))), ", "), F.lit("]"))
    return candidates.withColumn("unit_ids", ids)


def _sheet(df: DataFrame):
    """Headers and rows, partition by partition."""
    return df.columns, (tuple(r) for r in df.toLocalIterator())


GREEN, ORANGE, RED, YELLOW = "C6E0B4", "F8CBAD", "FF9999", "FFF2CC"


def _ranges(table: DataFrame, rows: int) -> dict[str, str]:
    """Where each column's values stand, by header; one row at least."""
    return {c: f"${x}$2:${x}${max(2, rows + 1)}" for c, x in ((c, xlsx.column_name(i)) for i, c in enumerate(table.columns))}


def review_rules(table: DataFrame, n: int, rows: int) -> xlsx.Rules:
    """Lists to choose from in the review sheet, and marks: by state, and whole rows that are complete while a passage is pending."""
    at, rules = _ranges(table, rows), xlsx.Rules()
    states, categories, documents = (f"listas!${c}$2:${c}${k + 1}" for c, k in zip("ABC", (len(SLOT_STATES), len(CATEGORIES), len(DOCUMENT_STATES))))
    first = {c: r.split(":")[0].replace("$2", "2") for c, r in at.items()}
    for i in range(1, n + 1):
        rules.lists += [(at[f"Categoria {i}"].replace("$", ""), categories), (at[f"Validação {i}"].replace("$", ""), states)]
        for state, colour in (("APROVADO", GREEN), ("AJUSTADO", ORANGE), ("REJEITADO", RED), ("PENDENTE", YELLOW)):
            rules.marks.append((at[f"Validação {i}"].replace("$", ""), f'{first[f"Validação {i}"]}="{state}"', colour))
    for i in range(1, review.MISSING + 1):
        rules.lists.append((at[f"Categoria ausente {i}"].replace("$", ""), categories))
    done = first["Status da decisão"]
    rules.lists.append((at["Status da decisão"].replace("$", ""), documents))
    rules.marks.append((at["Status da decisão"].replace("$", ""), f'{done}="VALIDADO_COMPLETO"', GREEN))
    if n:
        pending = ",".join(f'AND({first[f"Recorte {i}"]}<>"",{first[f"Validação {i}"]}="PENDENTE")' for i in range(1, n + 1))
        rules.marks.append((f"A2:{xlsx.column_name(len(table.columns) - 1)}{max(2, rows + 1)}", f'AND({done}="VALIDADO_COMPLETO",OR({pending}))', RED))
    return rules


def live_metrics(table: DataFrame, n: int, rows: int, values: dict) -> list[tuple]:
    """review.metrics as formulas over the review sheet, so that they follow the revision; values are shown until it is opened."""
    at = {c: f"'revisao'!{r}" for c, r in _ranges(table, rows).items()}

    def count(columns: list[str], what: str) -> str:
        return "+".join(f'COUNTIF({at[c]},"{what}")' for c in columns) or "0"

    def filled(columns: list[str]) -> str:  # an empty text counts as empty
        return "+".join(f'SUMPRODUCT(--({at[c]}<>""))' for c in columns) or "0"

    states, missing = [f"Validação {i}" for i in range(1, n + 1)], [f"Recorte ausente {i}" for i in range(1, review.MISSING + 1)]
    clean = ",".join([f'--({at["Status da decisão"]}="VALIDADO_COMPLETO")', *[f'--({at[c]}="")' for c in missing]])
    formulas = {
        "unique_decisions": f"COUNTA({at['ID']})", "complete": count(["Status da decisão"], "VALIDADO_COMPLETO"),
        "proposed": filled([f"Recorte {i}" for i in range(1, n + 1)]), "approved": count(states, "APROVADO"), "adjusted": count(states, "AJUSTADO"),
        "rejected": count(states, "REJEITADO"), "pending": count(states, "PENDENTE"), "additions": filled(missing), "complete_without_additions": f"SUMPRODUCT({clean})",
    }
    ref = {c: f"B{i}" for i, c in enumerate([*formulas, "strict_precision", "useful_rate", "recall", "complete_coverage", "f1"], 2)}
    ratios = {
        "strict_precision": "{approved}/({approved}+{adjusted}+{rejected})", "useful_rate": "({approved}+{adjusted})/({approved}+{adjusted}+{rejected})",
        "recall": "({approved}+{adjusted})/({approved}+{adjusted}+{additions})", "complete_coverage": "{complete_without_additions}/{complete}",
        "f1": "2*{strict_precision}*{recall}/({strict_precision}+{recall})",
    }
    formulas |= {c: f'IFERROR({f.format(**ref)},"")' for c, f in ratios.items()}
    return [(c, xlsx.Formula.of(f, values[c])) for c, f in formulas.items()]


def review_workbook(path: str, spark: SparkSession, built: DataFrame, candidates: DataFrame, n: int, additions: list[tuple] = ()) -> None:
    """The eight sheets of a review. A workbook is for people: use it for what they can review, the tables for the rest."""
    by = built.orderBy("first_row")
    kpi = review.metrics(built).head().asDict()
    table, rows = review.wide(by, n), kpi["unique_decisions"]
    additions_rules = xlsx.Rules(lists=[(f"{xlsx.column_name(ADDITIONS.index('categoria_gold'))}2:{xlsx.column_name(ADDITIONS.index('categoria_gold'))}5000", f"listas!$B$2:$B${len(CATEGORIES) + 1}")])
    xlsx.write(
        path,
        {
            "revisao": _sheet(table), "leitura_decisoes": _sheet(review.reading(by)),
            "metricas": (["métrica", "valor"], iter(live_metrics(table, n, rows, kpi))), "dados_tecnicos": _sheet(review.technical(by, n)),
            "candidatos_tecnicos": _sheet(predictions(candidates).orderBy("source_row", "candidate_rank")),
            "instrucoes": (list(STEPS[0]), iter(STEPS[1:])), "adicoes_gold": (ADDITIONS, iter(additions)), "listas": _sheet(review.lists(spark)),
        },
        hidden=HIDDEN,
        rules={"revisao": review_rules(table, n, rows), "adicoes_gold": additions_rules},
    )


def write_run(run: Run, out: str, settings: dict, began: float) -> dict:
    """predictions, errors, documents, review.xlsx and manifest.json below out; the manifest as a dict.

    The manifest's counters come with the write of documents; the review is made of what was written.
    """
    os.makedirs(out, exist_ok=True)
    spark = run.documents.sparkSession
    marked, seen = run.observed()
    marked.write.mode("overwrite").parquet(f"{out}/documents.parquet")
    documents = spark.read.parquet(f"{out}/documents.parquet")
    json_lines(predictions(run.candidates), f"{out}/predictions.jsonl", ["source_row", "candidate_rank"])
    json_lines(run.errors, f"{out}/errors.jsonl", ["source_row"])
    n = review.slot_count(run.candidates)
    review_workbook(f"{out}/review.xlsx", spark, review.build(documents, run.candidates, n=n), run.candidates, n)
    made = {"version": VERSION, **settings, **seen.get, "elapsed_seconds": round(time.time() - began, 3)}
    made |= {"review_workbook": f"{out}/review.xlsx", "review_sheet": "revisao", "metrics_sheet": "metricas"}
    with open(f"{out}/manifest.json", "w", encoding="utf-8") as f:
        json.dump(made, f, ensure_ascii=False, indent=2)
    return made


def _text(df: DataFrame, *names: str) -> Column:
    """The first of the columns that isn't empty."""
    have = [F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")) for c in names if c in df.columns]
    return F.coalesce(*have, F.lit("")) if have else F.lit("")


def _slots(df: DataFrame) -> int:
    n = 0
    while f"Recorte {n + 1}" in df.columns or f"candidate_{n + 1}_text" in df.columns:
        n += 1
    return n


def earlier_annotations(sheet: DataFrame) -> DataFrame:
    """A review sheet's human part, of this or the older layout, as review.build takes it."""
    n = _slots(sheet)
    slots = [
        F.struct(
            F.lit(i).alias("rank"), _text(sheet, f"Recorte {i}", f"recorte_{i}").alias("text"), _text(sheet, f"Categoria {i}", f"categoria_{i}").alias("category"),
            _text(sheet, f"candidate_{i}_texto_ajustado").alias("adjusted_text"), _text(sheet, f"candidate_{i}_categoria_ajustada").alias("adjusted_category"),
            _text(sheet, f"candidate_{i}_status", f"Validação {i}", f"validacao_{i}").alias("state"),
        )
        for i in range(1, n + 1)
    ]
    missing = [F.struct(_text(sheet, f"adicao_{i}_text", f"Recorte ausente {i}").alias("text"), _text(sheet, f"adicao_{i}_category", f"Categoria ausente {i}").alias("category")) for i in (1, 2)]
    none = F.expr("cast(array() as array<struct<rank:int,text:string,category:string,adjusted_text:string,adjusted_category:string,state:string>>)")
    return sheet.select(
        _text(sheet, "_decision_sha256", "decision_sha256").alias("key"), F.col("excel_row").alias("place"), (F.array(*slots) if slots else none).alias("slots"),
        F.array(*missing).alias("missing"), _text(sheet, "status_documento", "Status da decisão").alias("state"), _text(sheet, "revisor", "Revisor").alias("reviewer"),
        _text(sheet, "observacao_documento", "Observação").alias("note"),
    )


def _decisions(sheet: DataFrame) -> DataFrame:
    """The technical sheet as document rows, one for each source row that it lists."""
    rows = F.filter(F.transform(F.split(_text(sheet, "source_rows"), ","), lambda x: F.trim(x).try_cast("int")), lambda x: x.isNotNull())
    of = {"processo": "Processo", "expediente": "expedientes", "prazo": "prazos_origem", "link": "links_origem", "decision_sha256": "_decision_sha256"}
    names = ["processo", "expediente", "prazo", "link", "decision_sha256", *[c for c in review.FIRST_OF]]
    cols = [_text(sheet, of.get(c, c)).alias(c) for c in names]
    return sheet.select(F.explode_outer(rows).alias("source_row"), *cols, (F.lower(_text(sheet, "cache_reutilizado")) == "true").alias("cache_hit"))


def load_review(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """documents, candidates, earlier, additions of a review workbook; ValueError where its technical sheets are missing."""
    names = xlsx.Workbook(path).sheets

    def sheet(*wanted: str) -> DataFrame | None:
        return next((xlsx.read(spark, path, w, raw=True) for w in wanted if w in names), None)

    tables = {"decisions": sheet("decisoes"), "technical": sheet("dados_tecnicos"), "candidates": sheet("candidatos", "candidatos_tecnicos"),
              "reviewed": sheet("revisao", "revisao_consolidada"), "additions": sheet("adicoes_gold")}
    if tables["decisions"] is None and tables["technical"] is None or tables["candidates"] is None:
        raise ValueError("the workbook has no sheet of decisions or none of candidates")
    return tables


def _candidates(sheet: DataFrame) -> DataFrame:
    def text(c: str) -> Column:
        return _text(sheet, c).alias(c)

    return sheet.select(
        _text(sheet, "source_row").try_cast("int").alias("source_row"), text("Processo"), F.coalesce(_text(sheet, "candidate_rank").try_cast("int"), F.lit(0)).alias("candidate_rank"),
        F.from_json(_text(sheet, "unit_ids"), "array<string>").alias("unit_ids"), text("candidate_text"), text("teacher_category"),
        _text(sheet, "teacher_priority").try_cast("int").alias("teacher_priority"), text("teacher_reason"), text("decision_sha256"),
    )


def reviewed(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, int]:
    """(review with its human part, candidates, slots) of a workbook, without any selection being made anew."""
    t = load_review(spark, path)
    documents = _decisions(t["technical"]) if t["technical"] is not None else t["decisions"].withColumn("cache_hit", F.lower(_text(t["decisions"], "cache_hit")) == "true")
    candidates = _candidates(t["candidates"])
    earlier = earlier_annotations(t["reviewed"]) if t["reviewed"] is not None else None
    n = max(review.slot_count(candidates), _slots(t["reviewed"]) if t["reviewed"] is not None else 0)
    return review.build(documents, candidates, earlier, n), candidates, n


def additions(spark: SparkSession, path: str) -> DataFrame | None:
    sheet = load_review(spark, path)["additions"]
    if sheet is None or "texto_gold" not in sheet.columns:
        return None
    return sheet.select(
        _text(sheet, "decision_sha256").alias("sha"), _text(sheet, "ID").alias("id"), _text(sheet, "texto_gold").alias("text"), _text(sheet, "categoria_gold").alias("category"), F.col("excel_row").alias("place")
    )


def rebuild_review(spark: SparkSession, path: str, out: str) -> dict:
    """A new workbook from an existing one, edits and additions carried over."""
    built, candidates, n = reviewed(spark, path)
    more = additions(spark, path)
    kept = [] if more is None else [(r.id, r.sha, "", r.text, r.category, "", "", "") for r in more.where("trim(text) <> ''").orderBy("place").toLocalIterator()]
    review_workbook(out, spark, built, candidates, n, kept)
    return {"input": path, "output": out, "decisions": built.count(), "candidates": candidates.count(), "preserved_extra_additions": len(kept), "model_rerun": False}


def build_gold(spark: SparkSession, path: str, out: str) -> dict:
    """GOLD of a reviewed workbook as JSON lines in folder out, its issues as CSV beside it."""
    names = xlsx.Workbook(path).sheets
    if "revisao" in names and "dados_tecnicos" in names:
        judged = gold.judge(reviewed(spark, path)[0], additions(spark, path)).persist()
        gold.records(judged).write.mode("overwrite").option("ignoreNullFields", "false").json(out)
        beside = os.path.join(os.path.dirname(os.path.abspath(out)), "gold_build_issues.csv")
        with open(beside, "w", encoding="utf-8-sig", newline="") as f:
            rows = csv.writer(f)
            rows.writerow(["excel_row", "ID", "Processo", "issues"])
            rows.writerows(tuple(r) for r in gold.issues(judged).orderBy("excel_row").toLocalIterator())
        made = gold.metrics(judged).head().asDict() | {"output": out, "issues": beside, "source": "revisao"}
        judged.unpersist()
        return made
    if "revisao_consolidada" in names:
        sheet = xlsx.read(spark, path, "revisao_consolidada", raw=True)
        records, source = gold.consolidated(sheet, _slots(sheet)), "revisao_consolidada"
    else:
        long = [xlsx.read(spark, path, s, raw=True).withColumnRenamed("excel_row", "place") for s in ("decisoes", "candidatos", "adicoes_gold")]
        records, source = gold.from_long(long[0].drop("place"), *long[1:]), "legacy"
    records.write.mode("overwrite").json(out)
    return {"validated_documents": records.count(), "output": out, "source": source}
