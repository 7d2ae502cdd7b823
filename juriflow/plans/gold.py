"""GOLD records from a reviewed table: validated passages of complete decisions, or the issues that block them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from juriflow.functions.constants import CATEGORIES

_VALID = str(CATEGORIES)
_ITEM = "struct<text:string,category:string,source:string,validation:string>"
_NONE = f"cast(array() as array<{_ITEM}>)"


def _slot_facts() -> str:
    """SQL: per slot of a complete decision its issue, gold item, and what it counts for."""
    issue = (
        "CASE WHEN NOT s.used THEN NULL WHEN s.st NOT IN ('APROVADO', 'AJUSTADO', 'REJEITADO') THEN concat('candidato ', s.rank, ' ainda não revisado') "
        "WHEN s.st = 'REJEITADO' THEN NULL WHEN s.text = '' THEN concat('candidato ', s.rank, ' sem texto final') "
        f"WHEN s.category NOT IN {_VALID} THEN concat('candidato ', s.rank, ' com categoria inválida') END"
    )
    bare = "struct(s.rank AS rank, trim(s.text) AS text, trim(s.category) AS category, upper(trim(s.state)) AS st, trim(s.model_category) AS model_category, trim(s.text) <> '' OR trim(s.model_text) <> '' AS used)"
    good = f"s.used AND s.st IN ('APROVADO', 'AJUSTADO') AND s.text <> '' AND s.category IN {_VALID}"
    return (
        f"transform(transform(slots, s -> {bare}), s -> struct({issue} AS issue, {good} AS good, s.st AS st, s.used AND s.st = 'REJEITADO' AS rejected, "
        f"s.category = s.model_category AS same, struct(s.text AS text, s.category AS category, 'candidate' AS source, s.st AS validation) AS item))"
    )


def judge(review: DataFrame, additions: DataFrame | None = None) -> DataFrame:
    """Complete rows of a review (see review.build) with issues, gold and counters.

    additions: (sha, id, text, category, place): those with a hash belong to it, others to the id; the hash's come first.
    """
    done = review.where(F.upper(F.trim("state")) == "VALIDADO_COMPLETO").withColumn("facts", F.expr(_slot_facts()))
    if additions is None:
        done = done.withColumn("extra", F.expr("cast(array() as array<struct<text:string,category:string>>)"))
    else:
        own = additions.select(
            F.coalesce(F.nullif(F.trim(F.coalesce("sha", F.lit(""))), F.lit("")), F.trim(F.coalesce("id", F.lit("")))).alias("at"),
            F.struct("place", F.trim("text").alias("text"), F.trim(F.coalesce("category", F.lit(""))).alias("category")).alias("x"),
        ).where("x.text <> ''")
        listed = own.groupBy("at").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: F.struct(x["text"].alias("text"), x["category"].alias("category"))).alias("xs"))
        by_key, by_id = (listed.select(F.col("at").alias(k), F.col("xs").alias(v)) for k, v in (("key", "_by_key"), ("id", "_by_id")))
        done = done.join(by_key, "key", "left").join(by_id, "id", "left")
        none = F.expr("cast(array() as array<struct<text:string,category:string>>)")
        done = done.withColumn("extra", F.concat(F.coalesce("_by_key", none), F.coalesce("_by_id", none))).drop("_by_key", "_by_id")
    absent = "transform(missing, (m, i) -> struct(trim(m.text) AS text, trim(m.category) AS category, i + 1 AS place))"
    issues = (
        "filter(concat(transform(facts, f -> f.issue), "
        f"transform(_m, m -> CASE WHEN m.text <> '' AND m.category NOT IN {_VALID} THEN concat('recorte ausente ', m.place, ' sem categoria válida') END), "
        f"transform(extra, x -> CASE WHEN x.category NOT IN {_VALID} THEN 'adicao_gold com categoria inválida' END)), x -> x IS NOT NULL)"
    )
    human = f"cast(transform(filter({{}}, m -> m.text <> '' AND m.category IN {_VALID}), m -> struct(m.text, m.category, 'human_addition', cast(null as string))) as array<{_ITEM}>)"
    gold = f"concat(cast(transform(filter(facts, f -> f.good), f -> f.item) as array<{_ITEM}>), {human.format('_m')}, {human.format('extra')})"
    return done.withColumn("_m", F.expr(absent)).withColumns({"issues": F.expr(issues), "gold": F.expr(gold)}).drop("_m")


META = ("classe", "origem", "orgao_julgador", "data", "expediente", "prazo", "assunto", "secao_subsecao", "nucleo", "route_key", "specialist")


def records(judged: DataFrame, *more: F.Column) -> DataFrame:
    """GOLD documents: those without any issue; more: further columns made of the judged ones. Without decisao there is no decision."""
    of = {"expediente": "expedientes", "prazo": "prazos"}
    meta = F.struct(*[F.coalesce(F.col(of.get(c, c)).cast("string"), F.lit("")).alias(c) for c in META])
    rows = F.filter(F.transform(F.split("source_rows", ","), lambda x: F.trim(x)), lambda x: x != "")
    return judged.where(F.size("issues") == 0).select(
        F.get(rows, F.lit(0)).try_cast("int").alias("source_row"), rows.alias("source_rows"), F.col("key").alias("decision_sha256"),
        F.col("processo").alias("Processo"), meta.alias("metadata"), *[F.col(c).alias("decision") for c in judged.columns if c == "decisao"], "gold", *more,
    )


def issues(judged: DataFrame) -> DataFrame:
    """Blocked documents and why; excel_row follows the id."""
    return judged.where(F.size("issues") > 0).select(
        (F.substring("id", 2, 18).cast("int") + 1).alias("excel_row"), F.col("id").alias("ID"), F.col("processo").alias("Processo"), F.array_join("issues", "; ").alias("issues")
    )


def metrics(judged: DataFrame) -> DataFrame:
    """One row of counters; slots of documents that are blocked count too."""
    def total(condition: str) -> F.Column:
        return F.coalesce(F.sum(F.expr(f"size(filter(facts, f -> {condition}))")), F.lit(0)).cast("long")

    counted = judged.agg(
        F.count_if(F.size("issues") == 0).alias("validated_documents"), F.count_if(F.size("issues") > 0).alias("blocked_documents"),
        total("f.good AND f.st = 'APROVADO'").alias("approved"), total("f.good AND f.st = 'AJUSTADO'").alias("adjusted"),
        total("f.rejected").alias("rejected"), total("f.good AND f.same").alias("_same"),
    )
    return counted.withColumn("category_accuracy_on_useful", F.expr("try_divide(_same, approved + adjusted)")).drop("_same")


def consolidated(sheet: DataFrame, n: int) -> DataFrame:
    """GOLD documents of the older one-row layout (candidate_i_*, adicao_i_*): nothing blocks, no category is checked."""
    def text(c: str) -> F.Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("")) if c in sheet.columns else F.lit("")

    items = []
    for i in range(1, n + 1):
        st = F.upper(F.trim(text(f"candidate_{i}_status")))
        for kind, field in (("text", "texto_ajustado"), ("category", "categoria_ajustada")):
            model = text(f"candidate_{i}_{kind}")
            edited = F.coalesce(F.nullif(text(f"candidate_{i}_{field}"), F.lit("")), model)
            value = F.when(st == "APROVADO", model).when(st == "AJUSTADO", edited)
            items.append(value) if kind == "category" else items.append(F.when(F.trim(value) != "", value))
    built = [F.struct(t.alias("text"), c.alias("category"), F.lit("candidate").alias("source")) for t, c in zip(items[::2], items[1::2])]
    for i in range(1, 4):
        t = F.nullif(F.trim(text(f"adicao_{i}_text")), F.lit(""))
        c = F.coalesce(F.nullif(text(f"adicao_{i}_category"), F.lit("")), F.lit("outro_acionavel"))
        built.append(F.struct(t.alias("text"), c.alias("category"), F.lit("human_addition").alias("source")))
    rows = F.filter(F.transform(F.split(text("source_rows"), ","), lambda x: F.trim(x)), lambda x: x != "")
    of = {"expediente": "expedientes", "prazo": "prazos_origem"}
    return sheet.where(F.upper(F.trim(text("status_documento"))) == "VALIDADO_COMPLETO").select(
        F.get(rows, F.lit(0)).try_cast("int").alias("source_row"), rows.alias("source_rows"), text("decision_sha256").alias("decision_sha256"), text("Processo").alias("Processo"),
        F.struct(*[text(of.get(c, c)).alias(c) for c in META]).alias("metadata"), text("decisao").alias("decision"),
        F.filter(F.array(*built), lambda x: x["text"].isNotNull()).alias("gold"),
    )


def from_long(decisions: DataFrame, candidates: DataFrame, additions: DataFrame) -> DataFrame:
    """GOLD documents of the oldest layout, three long tables joined on the row number; rows without one are passed over."""
    def empty(c: str) -> F.Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    done = decisions.where(F.upper(F.trim(empty("status_documento"))) == "VALIDADO_COMPLETO").withColumn("_row", F.col("source_row").try_cast("int"))
    st = F.upper(F.trim(empty("status_validacao")))
    text = F.when(st == "APROVADO", empty("candidate_text")).when(st == "AJUSTADO", F.coalesce(F.nullif(empty("texto_ajustado"), F.lit("")), empty("candidate_text")))
    name = F.when(st == "APROVADO", empty("teacher_category")).when(st == "AJUSTADO", F.coalesce(F.nullif(empty("categoria_ajustada"), F.lit("")), empty("teacher_category")))
    some = candidates.select(F.col("source_row").try_cast("int").alias("_row"), F.struct(F.lit(0).alias("part"), F.col("place"), text.alias("text"), name.alias("category"), F.lit("candidate").alias("source")).alias("x"))
    more = additions.select(
        F.col("source_row").try_cast("int").alias("_row"),
        F.struct(F.lit(1).alias("part"), F.col("place"), empty("texto_gold").alias("text"), F.coalesce(F.nullif(empty("categoria_gold"), F.lit("")), F.lit("outro_acionavel")).alias("category"), F.lit("human_addition").alias("source")).alias("x"),
    )
    both = some.unionByName(more).where("_row IS NOT NULL AND trim(x.text) <> ''")
    items = both.groupBy("_row").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: F.struct(x["text"].alias("text"), x["category"].alias("category"), x["source"].alias("source"))).alias("gold"))
    meta = F.struct(*[c for c in decisions.columns if c not in ("decisao", "status_documento")])
    joined = done.where("_row IS NOT NULL").join(items, "_row", "left")
    none = F.expr("cast(array() as array<struct<text:string,category:string,source:string>>)")
    return joined.select(F.col("_row").alias("source_row"), F.col("processo").alias("Processo"), meta.alias("metadata"), empty("decisao").alias("decision"), F.coalesce("gold", none).alias("gold"))
