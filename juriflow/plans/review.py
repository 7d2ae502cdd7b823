"""The review table: one row for each different decision, its candidates in slots, earlier annotations merged in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from juriflow.functions.constants import CATEGORIES, DOCUMENT_STATES, SLOT_STATES

MISSING = 2
#: Rows of the input whose decisions are numbered in one task.
BLOCK = 100_000


def _filled(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def decision_key(sha: str = "decision_sha256", row: str = "source_row") -> Column:
    return F.coalesce(F.nullif(F.col(sha), F.lit("")), F.concat(F.lit("source_row:"), F.col(row).cast("string")))


def _listed(c: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(F.when(F.trim(_filled(c)) != "", _filled(c)))), " | ")


FIRST_OF = (
    "classe", "origem", "orgao_julgador", "data", "assunto", "secao_subsecao", "nucleo", "rule_id", "rule_label", "route_key",
    "specialist", "teacher_status", "teacher_attempts", "teacher_response_mode", "decisao",
)


def groups(documents: DataFrame) -> DataFrame:
    """A row for each decision key: the first row's columns, all rows' lists and counts, and id by first appearance.

    Documents without their texts (decisao) give groups without them: a min_by of a struct carries all of it, whether asked for or not.
    """
    keyed = documents.withColumn("key", decision_key())
    first = F.min_by(F.struct(*[c for c in FIRST_OF if c != "decisao" or c in documents.columns]), "source_row").alias("f")
    rows = F.array_join(F.transform(F.array_sort(F.collect_list("source_row")), lambda x: x.cast("string")), ", ")
    grouped = keyed.groupBy("key").agg(
        first, F.min("source_row").alias("first_row"), rows.alias("source_rows"), F.count("*").alias("occurrences"),
        *[_listed(c).alias(f"{c}s") for c in ("processo", "expediente", "prazo", "link")], F.bool_or("cache_hit").alias("_hit"),
    )
    # numbered by rows that hold no text: places within blocks of first rows, and the blocks' sums, a row for BLOCK rows
    slim = grouped.select("key", "first_row", F.floor(F.col("first_row") / BLOCK).alias("_block"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = slim.groupBy("_block").agg(F.count("*").alias("_n")).select("_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_block").orderBy("first_row"))
    numbers = slim.withColumn("_place", place).join(sums, "_block").select("key", (F.col("_before") + F.col("_place")).alias("_number"))
    return grouped.join(numbers, "key").select(
        "key", F.format_string("D%04d", "_number").alias("id"), "first_row", "source_rows", "occurrences",
        F.col("processos").alias("processo"), "expedientes", "prazos", "links", (F.col("_hit") | (F.col("occurrences") > 1)).alias("reused"), "f.*",
    )


def slots(candidates: DataFrame) -> DataFrame:
    """key, rank and the first candidate of that rank."""
    keyed = candidates.withColumn("key", decision_key()).where("candidate_rank > 0")
    first = F.min_by(
        F.struct(F.col("candidate_text").alias("text"), F.col("teacher_category").alias("category"), "teacher_priority", "teacher_reason"), "source_row"
    )
    return keyed.groupBy("key", F.col("candidate_rank").alias("rank")).agg(first.alias("c")).select("key", "rank", "c.*")


def slot_count(candidates: DataFrame) -> int:
    most = candidates.agg(F.max("candidate_rank")).head()[0]
    return max(3, most or 0)


def annotations(earlier: DataFrame) -> DataFrame:
    """The last row of each non-blank key; earlier: key, place, slots, missing, state, reviewer, note."""
    return earlier.where(F.trim(_filled("key")) != "").groupBy("key").agg(F.max_by(F.struct(*[c for c in earlier.columns if c != "key"]), "place").alias("a"))


#: What annotations() gives for each key.
EARLIER = (
    "struct<place:int,slots:array<struct<rank:int,text:string,category:string,adjusted_text:string,adjusted_category:string,state:string>>,"
    "missing:array<struct<text:string,category:string>>,state:string,reviewer:string,note:string>"
)


def build(documents: DataFrame, candidates: DataFrame, earlier: DataFrame | None = None, n: int | None = None) -> DataFrame:
    """The review: groups' columns, slots (n of them: text, category, state, and what was proposed), missing, state, reviewer, note.

    An edited text of an earlier review wins over an adjusted one (of a slot AJUSTADO), and both over the proposal.
    """
    n = n or slot_count(candidates)
    given = slots(candidates).groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("rank", F.struct("text", "category", "teacher_priority", "teacher_reason")))).alias("given"))
    table = groups(documents).join(given, "key", "left")
    if earlier is not None:
        table = table.join(annotations(earlier), "key", "left")
    else:
        table = table.withColumn("a", F.lit(None).cast(EARLIER))
    one = (
        "element_at(transform(array(struct(element_at(given, i) AS g, element_at(filter(coalesce(a.slots, array()), s -> s.rank = i), 1) AS o)), x -> "
        "element_at(transform(array(upper(trim(coalesce(x.o.state, '')))), st -> struct(i AS rank, "
        "CASE WHEN coalesce(x.o.text, '') <> '' THEN x.o.text WHEN st = 'AJUSTADO' AND trim(coalesce(x.o.adjusted_text, '')) <> '' THEN trim(x.o.adjusted_text) ELSE coalesce(x.g.text, '') END AS text, "
        "CASE WHEN coalesce(x.o.category, '') <> '' THEN x.o.category WHEN st = 'AJUSTADO' AND trim(coalesce(x.o.adjusted_category, '')) <> '' THEN trim(x.o.adjusted_category) ELSE coalesce(x.g.category, '') END AS category, "
        f"CASE WHEN coalesce(x.g.text, '') = '' THEN '' WHEN st IN {SLOT_STATES} THEN st ELSE 'PENDENTE' END AS state, "
        "coalesce(x.g.text, '') AS model_text, coalesce(x.g.category, '') AS model_category, x.g.teacher_priority AS priority, coalesce(x.g.teacher_reason, '') AS reason)), 1)), 1)"
    )
    one = one.replace("element_at(filter(", "try_element_at(filter(").replace("element_at(given, i)", "try_element_at(given, i)")
    state = F.upper(F.trim(F.coalesce("a.state", F.lit(""))))
    missing = f"transform(sequence(1, {MISSING}), i -> struct(coalesce(try_element_at(a.missing, i).text, '') AS text, coalesce(try_element_at(a.missing, i).category, '') AS category))"
    built = table.withColumns(
        {
            "slots": F.expr(f"transform(sequence(1, {n}), i -> {one})"), "missing": F.expr(missing),
            "state": F.when(state.isin(*DOCUMENT_STATES), state).otherwise("PENDENTE_REVISAO"),
            "reviewer": F.coalesce("a.reviewer", F.lit("")), "note": F.coalesce("a.note", F.lit("")),
        }
    )
    return built.drop("a", "given")


def alert(review: DataFrame) -> DataFrame:
    """review with complete_with_pending: marked complete while a filled slot is still pending."""
    pending = F.exists("slots", lambda s: (s["text"] != "") & (s["state"] == "PENDENTE"))
    return review.withColumn("complete_with_pending", (F.col("state") == "VALIDADO_COMPLETO") & pending)


def wide(review: DataFrame, n: int) -> DataFrame:
    """The review as reviewers see it: three columns a slot, two for each missing passage."""
    cols = [F.col("key").alias("_decision_sha256"), F.col("id").alias("ID"), F.col("processo").alias("Processo"), F.col("classe").alias("Classe"),
            F.col("orgao_julgador").alias("Órgão julgador"), F.col("expedientes").alias("Expediente"), F.col("prazos").alias("Prazo"), F.col("assunto").alias("Assunto")]
    for i in range(n):
        s = F.col("slots")[i]
        cols += [s["text"].alias(f"Recorte {i + 1}"), s["category"].alias(f"Categoria {i + 1}"), s["state"].alias(f"Validação {i + 1}")]
    for i in range(MISSING):
        m = F.col("missing")[i]
        cols += [m["text"].alias(f"Recorte ausente {i + 1}"), m["category"].alias(f"Categoria ausente {i + 1}")]
    return review.select(*cols, F.col("state").alias("Status da decisão"), F.col("reviewer").alias("Revisor"), F.col("note").alias("Observação"))


def technical(review: DataFrame, n: int) -> DataFrame:
    """Where each review row comes from: 24 columns and four a slot."""
    cols = [F.col("key").alias("_decision_sha256"), F.col("id").alias("ID"), "source_rows", F.col("occurrences").alias("ocorrencias_na_base"),
            F.col("processo").alias("Processo"), "classe", "origem", "orgao_julgador", "data", "expedientes", F.col("prazos").alias("prazos_origem"), "assunto",
            "secao_subsecao", "nucleo", "rule_id", "rule_label", "route_key", "specialist", "teacher_status", "teacher_attempts", "teacher_response_mode",
            F.col("reused").alias("cache_reutilizado"), F.col("links").alias("links_origem"), "decisao"]
    for i in range(n):
        s = F.col("slots")[i]
        cols += [s[a].alias(f"teacher_{b}_{i + 1}") for a, b in (("model_text", "text"), ("model_category", "category"), ("priority", "priority"), ("reason", "reason"))]
    return review.select(*cols)


def reading(review: DataFrame) -> DataFrame:
    """Whole texts to read."""
    return review.select(F.col("id").alias("ID"), F.col("processo").alias("Processo"), F.col("classe").alias("Classe"), F.col("assunto").alias("Assunto"), F.col("decisao").alias("Decisão completa"))


def metrics(review: DataFrame) -> DataFrame:
    """One row: counts over rows and slots, and the ratios of them (null where there is nothing to divide by)."""
    def slots_of(state: str) -> Column:
        return F.coalesce(F.sum(F.size(F.filter("slots", lambda s: s["state"] == state))), F.lit(0)).cast("long")

    complete = F.col("state") == "VALIDADO_COMPLETO"
    counts = review.agg(
        F.count("*").alias("unique_decisions"),
        F.count_if(complete).alias("complete"),
        F.coalesce(F.sum(F.size(F.filter("slots", lambda s: s["text"] != ""))), F.lit(0)).cast("long").alias("proposed"),
        slots_of("APROVADO").alias("approved"), slots_of("AJUSTADO").alias("adjusted"), slots_of("REJEITADO").alias("rejected"), slots_of("PENDENTE").alias("pending"),
        F.coalesce(F.sum(F.size(F.filter("missing", lambda m: m["text"] != ""))), F.lit(0)).cast("long").alias("additions"),
        F.count_if(complete & ~F.exists("missing", lambda m: m["text"] != "")).alias("complete_without_additions"),
    )
    ratios = counts.withColumns(
        {
            "strict_precision": F.expr("try_divide(approved, approved + adjusted + rejected)"),
            "useful_rate": F.expr("try_divide(approved + adjusted, approved + adjusted + rejected)"),
            "recall": F.expr("try_divide(approved + adjusted, approved + adjusted + additions)"),
            "complete_coverage": F.expr("try_divide(complete_without_additions, complete)"),
        }
    )
    # as in the sheet, the harmonic mean is of the strict precision and the recall
    return ratios.withColumn("f1", F.expr("try_divide(2 * strict_precision * recall, strict_precision + recall)"))


def lists(spark) -> DataFrame:
    """Values of the drop-down lists, padded with blanks."""
    n = max(len(CATEGORIES), len(SLOT_STATES), len(DOCUMENT_STATES))
    pad = [[*x, *[""] * (n - len(x))] for x in (SLOT_STATES, CATEGORIES, DOCUMENT_STATES)]
    return spark.createDataFrame(list(zip(*pad)), "validacao string, categoria string, status_documento string")
