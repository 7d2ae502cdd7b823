"""The extraction run: scope, limits, selection, candidates, document states and the run's counters."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from juriflow.functions.constants import COLUMNS
from juriflow.functions.text import is_blank, is_tax_foreclosure, normalize, strip, text_hash
from juriflow.operators import rules, select
from juriflow.operators.router import PROFILES, route
from juriflow.operators.segment import reconstruct_sql, unit_lists, unit_texts

EXCLUDED, EMPTY, PENDING = "EXCLUIDO_EXECUCAO_FISCAL", "SEM_DECISAO", "PENDENTE_REVISAO"
#: A text of more rows than this is dealt to several tasks where rows meet what was selected from their text.
HOT_ROWS = 20_000
#: There are at most this many such texts, whatever the input: beyond it a text needs more rows to be one.
HOT_MOST = 100_000


@dataclass
class Run:
    """Tables of a run, each planned where it is first asked for; manifest is one row, selections has one for each text that this run selected from."""

    rows: DataFrame
    done: DataFrame
    asked: bool
    selections: DataFrame
    kept: list[DataFrame] = field(default_factory=list)
    known: DataFrame | None = None
    hot_rows: int = HOT_ROWS
    every: DataFrame | None = None

    @cached_property
    def proposals(self) -> DataFrame:
        """What review.slots asks of candidates, for the first row of each text alone: no row meets its text for that."""
        texts = self.every.withColumnRenamed("first_row", "source_row")
        return _spread(texts).select("source_row", "decision_sha256", *PROPOSED)

    @cached_property
    def hits(self) -> DataFrame:
        """source_row, decision_sha256, cache_hit of the pending rows, as documents have them: told from hashes and row numbers, nothing is selected."""
        firsts = first_rows(self.rows)
        texts = firsts.select("decision_sha256", "first_row").withColumn("_known", F.lit(False))
        if self.known is not None:
            had = self.known.select("decision_sha256", F.lit(True).alias("_had")).distinct()
            texts = texts.join(had, "decision_sha256", "left").withColumn("_known", F.coalesce("_had", F.lit(False))).drop("_had")
        rows = self.rows.where(F.col("state") == PENDING).select("source_row", "decision_sha256")
        met = by_text(rows, texts, hot_texts(firsts, self.hot_rows))
        hit = (F.col("_known") | (F.col("source_row") != F.col("first_row"))) & F.lit(self.asked)
        return met.select("source_row", "decision_sha256", hit.alias("cache_hit"))

    @cached_property
    def marked(self) -> DataFrame:
        """documents with _first: whether a row is the first of its text."""
        return _documents(self.rows, self.done)

    @cached_property
    def documents(self) -> DataFrame:
        return self.marked.drop("_first")

    @cached_property
    def candidates(self) -> DataFrame:
        return _candidates(self.done)

    @cached_property
    def errors(self) -> DataFrame:
        found = self.done.where("_first AND NOT _known AND error IS NOT NULL")
        return found.select("source_row", "processo", F.lit("RECOVERED").alias("severity"), "teacher_status", "error")

    @cached_property
    def manifest(self) -> DataFrame:
        return self.marked.agg(*_counters(self.asked))

    def observed(self) -> tuple[DataFrame, Observation]:
        """documents, and the manifest's counters as they come with the first action on them (a write): no pass of their own."""
        seen = Observation()
        return self.marked.observe(seen, *_counters(self.asked)).drop("_first"), seen

    def unpersist(self) -> None:
        for df in self.kept:
            df.unpersist()


def canonical(df: DataFrame) -> DataFrame:
    """df with source_row and all known columns; missing ones are null, processo and decisao never."""
    have = {c.lower(): c for c in df.columns}
    cols = [F.col(have[c]).cast("string").alias(c) if c in have else F.lit(None).cast("string").alias(c) for c in COLUMNS]
    out = df.select(F.col("source_row").cast("int").alias("source_row"), *cols)
    return out.withColumns({c: F.coalesce(c, F.lit("")) for c in ("processo", "decisao")})


def scope(df: DataFrame, include_tax: bool = False) -> DataFrame:
    """df with state: excluded, empty or pending; excluded is looked at first."""
    out = F.lit(False) if include_tax else is_tax_foreclosure(F.col("classe"))
    return df.withColumn("state", F.when(out, EXCLUDED).when(is_blank(F.coalesce("decisao", F.lit(""))), EMPTY).otherwise(PENDING))


def window_rows(df: DataFrame, start: int = 0, limit: int | None = None) -> DataFrame:
    """Rows start .. start + limit by place in the sheet (the first data row is row 2); limit 0 is no row."""
    first = 2 + start
    df = df.where(F.col("source_row") >= first)
    return df if limit is None else df.where(F.col("source_row") < first + limit)


def unique_cutoff(df: DataFrame, most: int | None, known: DataFrame | None = None) -> DataFrame:
    """Rows up to the one with the most-th different text that isn't known; df has state and decision_sha256.

    The cut lies at the N-th smallest first row of a text: a top-N over one row per text, no running count.
    """
    if most is None:
        return df
    if most <= 0:
        return df.limit(0)
    counted = df.where(F.col("state") == PENDING)
    if known is not None:
        counted = counted.join(known.select("decision_sha256"), "decision_sha256", "left_anti")
    firsts = counted.groupBy("decision_sha256").agg(F.min("source_row").alias("first"))
    last = firsts.orderBy("first").limit(most).agg(F.when(F.count("*") >= most, F.max("first")).alias("last"))
    return df.crossJoin(F.broadcast(last)).where("last IS NULL OR source_row <= last").drop("last")  # one row


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("decision_sha256", F.when(F.col("state") == PENDING, text_hash(F.col("decisao"))).otherwise(""))


def settled(df: DataFrame) -> DataFrame:
    """df whose columns aren't worked out again by whatever uses them: the optimizer moves nothing through a filter that isn't deterministic."""
    return df.withColumn("_at", F.monotonically_increasing_id()).where("_at >= 0").drop("_at")


def first_rows(rows: DataFrame) -> DataFrame:
    """decision_sha256, first_row, n: a row for each pending text; hashes and numbers alone, summed up before they are dealt."""
    return rows.where(F.col("state") == PENDING).groupBy("decision_sha256").agg(F.min("source_row").alias("first_row"), F.count("*").alias("n"))


def hot_texts(firsts: DataFrame, hot_rows: int = HOT_ROWS, hot_most: int = HOT_MOST) -> DataFrame:
    """decision_sha256, parts: into how many parts the rows of a text are split, of the texts that are; hot_most of them at most, as each has
    more than a hot_most-th of all rows."""
    total = firsts.agg(F.sum("n").alias("_total"))
    most = F.greatest(F.lit(hot_rows), F.expr(f"_total div {hot_most}"))
    return firsts.crossJoin(F.broadcast(total)).where(F.col("n") > most).select("decision_sha256", F.ceil(F.col("n") / most).cast("int").alias("parts"))


def by_text(rows: DataFrame, texts: DataFrame, hot: DataFrame) -> DataFrame:
    """rows with texts' columns of their decision_sha256. Rows of a hot text go to as many tasks as it has parts, and its row of texts to each."""
    hot = F.broadcast(hot)  # bounded by hot_texts
    dealt = rows.join(hot, "decision_sha256", "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64("source_row"), F.col("parts")), F.lit(0)).cast("int"))
    copies = texts.join(hot, "decision_sha256", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    return dealt.drop("parts").join(copies.drop("parts"), ["decision_sha256", "_part"]).drop("_part")


def run(
    df: DataFrame,
    mode: str = "rules",
    max_candidates: int = 3,
    include_tax: bool = False,
    start: int = 0,
    limit: int | None = None,
    unique_limit: int | None = None,
    profiles: tuple[dict, ...] = PROFILES,
    teacher=None,
    known: DataFrame | None = None,
    keep: bool = False,
    hot_rows: int = HOT_ROWS,
    ascii_words: bool = False,
) -> Run:
    """mode: rules; fallback (every model call fails); llama: teacher(first rows with units) -> selections by text.

    known: selections of earlier runs; their texts are not selected from again. keep: persist what several of the run's tables are made of,
    until unpersist(). source_row tells the rows apart. ascii_words: see noise.rejection.

    Each different text is folded, ruled and selected from once: its first row is found by an aggregation that leaves one row a text and task. Rows then meet what is known of their text, with those of a hot text split; only their notice is their own.
    """
    if mode not in ("rules", "fallback", "llama"):
        raise ValueError("mode must be rules, fallback or llama")
    if mode == "llama" and teacher is None:
        raise ValueError("mode llama needs a teacher")
    rows = unique_cutoff(_keyed(scope(window_rows(canonical(df), start, limit), include_tax)), unique_limit, known)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK) if keep else settled(rows)
    pending = rows.where(F.col("state") == PENDING)
    firsts = first_rows(rows)
    live = route(pending, profiles)
    asked_of = [c for c in live.columns if c != "decision_sha256"] if mode == "llama" else ["source_row", "decisao", "expediente"]
    once = live.groupBy("decision_sha256").agg(F.min_by(F.struct(*asked_of), "source_row").alias("_row"))
    once = once.select("decision_sha256", "_row.*").withColumn("_sought", rules.sought(F.col("decisao")))
    once = _ruled(once.withColumn("text_bits", rules.text_bits(F.col("decisao"), F.col("_sought"))).drop("_sought"))
    if known is not None:
        once = once.join(known.select("decision_sha256"), "decision_sha256", "left_anti")
    chosen = _choose(once, mode, max_candidates, teacher, ascii_words)
    chosen = chosen.persist(StorageLevel.MEMORY_AND_DISK) if keep else chosen
    every = chosen.withColumn("_known", F.lit(False))
    if known is not None:
        earlier = known.join(firsts.select("decision_sha256", "first_row"), "decision_sha256").select(*chosen.columns)
        every = every.unionByName(earlier.withColumn("_known", F.lit(True)))
    done = _ruled(by_text(live, every, hot_texts(firsts, hot_rows))).withColumn("_first", F.col("source_row") == F.col("first_row"))
    asked = mode != "rules"
    done = done.withColumn("cache_hit", (F.col("_known") | ~F.col("_first")) & F.lit(asked))
    return Run(rows, done, asked, chosen.drop("first_row"), [rows, chosen] if keep else [], known, hot_rows, every)


def _ruled(live: DataFrame) -> DataFrame:
    """Rows with text_bits, what rules ask of their text, with their rule."""
    live = live.withColumn("_notice", normalize(F.col("expediente"))).withColumn("rule", rules.by_bits(F.col("text_bits"), F.col("_notice")))
    return live.withColumns({"rule_id": F.col("rule.rule_id"), "rule_label": F.col("rule.label")}).drop("rule", "_notice")


def _choose(once: DataFrame, mode: str, most: int, teacher, ascii_words: bool) -> DataFrame:
    """decision_sha256, first_row, text_bits, selected (with texts), teacher_status, teacher_attempts, teacher_response_mode, error: a row for each text."""
    key = ["decision_sha256"]
    labelled = [] if mode == "rules" else ["label"]
    texts = once.withColumn("label", normalize(F.col("rule_label")))
    slim = mode == "rules" and most > 0
    if slim:  # of other units than those that are picked nothing is asked, so they are not dealt or judged
        lists = once.select(*key, "source_row", "text_bits", select.first_openings(unit_texts(F.col("decisao")), most, ascii_words).alias("marked"))
    elif mode == "llama":
        lists = once.join(unit_lists(texts, [*key, *labelled], marks=select.marks(mode), ascii_words=ascii_words).drop("label"), key, "left")
    else:  # what is asked of a text goes with its units, so that texts are looked up and dealt once
        more = ["source_row", "text_bits", *labelled, *(["rule_id", "rule_label"] if labelled else [])]
        lists = unit_lists(texts, [*key, *more], marks=select.marks(mode), every=True, ascii_words=ascii_words)
    if mode == "rules":
        picked = select.opened_items(F.col("marked")) if slim else select.opening_items(F.col("marked"), most)
        attempts, reply, error, ok, empty = 0, "rules", None, "OK", "EMPTY_VALID"
    else:
        picked = select.rule_items(F.col("marked"), most)
        attempts, reply, error, ok, empty = 2, "fallback", "model unavailable", "RULE_FALLBACK", "RULE_FALLBACK_EMPTY"
    lists = lists.withColumn("_picked", picked)
    if mode == "llama":
        answered = teacher(lists.drop("marked", "_picked"), most)
        joined = lists.join(answered, key, "left")
        failed = F.col("error").isNotNull()
        spare = F.coalesce("_picked", F.expr("filter(selected, x -> false)"))
        joined = joined.withColumn("selected", F.when(failed, spare).otherwise(F.col("selected")))
        status = F.when(~failed, F.col("teacher_status")).when(F.size("selected") > 0, "RULE_FALLBACK").otherwise("RULE_FALLBACK_EMPTY")
        joined = joined.withColumn("teacher_status", status)
    else:
        none = F.expr("cast(array() as array<struct<rank:int,unit_ids:array<string>,category:string,priority:int,reason:string>>)")
        joined = lists.withColumn("selected", F.coalesce("_picked", none)).withColumns(
            {
                "teacher_status": F.when(F.size("selected") > 0, ok).otherwise(empty), "teacher_attempts": F.lit(attempts),
                "teacher_response_mode": F.lit(reply), "error": F.lit(error).cast("string"),
            }
        )
    # what is picked by rule is single units, whose texts are at hand
    text = reconstruct_sql("decisao", "s.unit_ids", "units") if mode == "llama" else "element_at(filter(marked, u -> u.unit_id = element_at(s.unit_ids, 1)), 1).text"
    with_text = F.expr(f"transform(selected, s -> struct(s.rank AS rank, s.unit_ids AS unit_ids, s.category AS category, s.priority AS priority, s.reason AS reason, {text} AS text))")
    joined = joined.withColumn("selected", with_text)
    return joined.select(*key, F.col("source_row").alias("first_row"), "text_bits", "selected", "teacher_status", "teacher_attempts", "teacher_response_mode", "error")


PROPOSED = ("candidate_rank", "candidate_text", "teacher_category", "teacher_priority", "teacher_reason")


def _spread(df: DataFrame) -> DataFrame:
    """df with a row for each of selected, or one of rank 0 where there is none."""
    return df.select("*", F.explode_outer("selected").alias("_s")).withColumns(
        {
            "candidate_rank": F.coalesce(F.col("_s.rank"), F.lit(0)).cast("int"),
            "unit_ids": F.coalesce(F.col("_s.unit_ids"), F.array().cast("array<string>")),
            "candidate_text": F.coalesce(F.col("_s.text"), F.lit("")),
            "teacher_category": F.coalesce(F.col("_s.category"), F.lit("")),
            "teacher_priority": F.col("_s.priority").cast("int"),
            "teacher_reason": F.coalesce(F.col("_s.reason"), F.lit("")),
        }
    )


def _candidates(done: DataFrame) -> DataFrame:
    """A row for each selection, or one of rank 0 for a text without any."""
    return _spread(done).select(
        "source_row",
        F.col("processo").alias("Processo"),
        "candidate_rank",
        "unit_ids",
        "candidate_text",
        "teacher_category",
        "teacher_priority",
        "teacher_reason",
        F.coalesce("rule_id", F.lit("")).alias("rule_id"),
        F.coalesce("rule_label", F.lit("")).alias("rule_label"),
        "route_key",
        "specialist",
        "teacher_status",
        "teacher_attempts",
        "teacher_response_mode",
        "decision_sha256",
        "cache_hit",
        *[F.lit("").alias(c) for c in ("status_validacao", "texto_ajustado", "categoria_ajustada", "observacao", "revisor", "revisado_em")],
    )


def _documents(rows: DataFrame, done: DataFrame) -> DataFrame:
    """A row for each scanned row with its state, and _first: whether it is the first of its text."""
    blank = {"rule_id": "", "rule_label": "", "route_key": "", "specialist": "", "teacher_status": "", "teacher_response_mode": ""}

    def shaped(df: DataFrame, given: dict[str, Column]) -> DataFrame:
        cols = {c: F.lit(v) for c, v in blank.items()} | given
        return df.select(
            "source_row", *COLUMNS, F.col("state").alias("status_documento"), *[v.alias(c) for c, v in cols.items()],
            (given["_attempts"] if "_attempts" in given else F.lit(0)).cast("int").alias("teacher_attempts"), "decision_sha256",
            (given["_cache"] if "_cache" in given else F.lit(False)).alias("cache_hit"),
            (given["_n"] if "_n" in given else F.lit(0)).cast("int").alias("teacher_recortes_count"), (given["_1st"] if "_1st" in given else F.lit(False)).alias("_first"),
        ).drop("_attempts", "_cache", "_n", "_1st")

    given = {c: F.coalesce(c, F.lit("")) for c in blank}
    given |= {"_attempts": F.col("teacher_attempts"), "_cache": F.col("cache_hit"), "_n": F.size("selected"), "_1st": F.col("_first")}
    return shaped(rows.where(F.col("state") != PENDING), {}).unionByName(shaped(done, given))


def _counters(asked: bool) -> list[Column]:
    """The manifest's counters over the marked documents."""

    def count_if(condition: Column, name: str) -> Column:
        return F.count_if(condition).alias(name)

    state, first = F.col("status_documento"), ~F.col("cache_hit") & F.lit(asked)
    pending = state == PENDING
    status = F.col("teacher_status")
    return [
        F.count("*").alias("scanned"),
        count_if(pending, "processed"),
        count_if(pending & F.col("_first"), "unique_decisions"),
        F.count(F.lit(None)).alias("errors"),
        count_if(pending & first & status.startswith("RULE_FALLBACK"), "recovered_errors"),
        count_if(pending & first, "unique_inferences"),
        count_if(F.col("cache_hit"), "cache_hits"),
        count_if(pending & first & (status == "RETRY_OK"), "teacher_retries_ok"),
        count_if(pending & first & (status == "RULE_FALLBACK"), "rule_fallbacks"),
        count_if(pending & first & (status == "RULE_FALLBACK_EMPTY"), "rule_fallback_empty"),
        count_if(pending & first & (status == "EMPTY_VALID"), "empty_valid"),
        count_if(state == EMPTY, "skipped_empty_decisions"),
    ]


def inspect(df: DataFrame, limit: int | None = None) -> dict[str, DataFrame]:
    """rows (one row of counters), top_classes, top_organs, class_families; limit 0 is none. Ties keep first-seen order."""
    from juriflow.functions.text import class_family

    rows = canonical(df)
    if limit:
        rows = window_rows(rows, 0, limit)
    counters = rows.agg(
        F.count("*").alias("rows"),
        F.count_if(strip(F.col("decisao")) == "").alias("empty_decisions"),
        F.count_if(is_tax_foreclosure(F.col("classe"))).alias("execucao_fiscal"),
    )

    def top(value: Column, name: str, n: int) -> DataFrame:
        counted = rows.groupBy(value.alias(name)).agg(F.count("*").alias("n"), F.min("source_row").alias("first"))
        return counted.orderBy(F.desc("n"), "first").limit(n)

    return {
        "rows": counters,
        "top_classes": top(F.coalesce("classe", F.lit("None")), "classe", 10),
        "top_organs": top(F.coalesce("orgao_julgador", F.lit("None")), "orgao_julgador", 10),
        "class_families": top(class_family(F.col("classe")), "class_family", 20),
    }
