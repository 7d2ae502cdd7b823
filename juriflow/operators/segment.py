"""Segmentation of decisions into exactly addressed units, and verbatim reconstruction of chosen ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from juriflow.functions.text import BLANK, WS, let, normalize, strip, strip_some
from juriflow.operators.noise import rejection

# Section headings, block and sentence boundaries, the length from which blocks are split.
SECTIONS = {
    "RELATÓRIO": "RELATORIO", "RELATORIO": "RELATORIO", "FUNDAMENTAÇÃO": "FUNDAMENTACAO", "FUNDAMENTACAO": "FUNDAMENTACAO",
    "DECIDO": "DECISAO", "DECISÃO": "DECISAO", "DECISAO": "DECISAO", "DISPOSITIVO": "DISPOSITIVO",
}
BLOCK_GAP = rf"\n{WS}*\n+"
# What is looked ahead for is all that white space can be; it passes letters over by one comparison.
SENTENCE_GAP = rf"(?=[^\x21-\x7e])(?<=[.!?;]){WS}+(?=[A-ZÁÉÍÓÚÂÊÔÃÕÇ])"
LONG = 1200
FIRST_SECTION = "OUTRO"
NEAR = 8
#: So many pieces of a text are placed one behind the other; more of them by such shares.
SHARE = 128

UNIT = "struct<unit_id: string, start: int, end: int, text: string, section: string, rejected: string>"


def _pieces(text: str, gap: str) -> Column:
    """array<struct<piece, size>>: pieces between gaps, each with its length and that of the gap behind it."""
    return F.expr(
        f"zip_with(split({text}, r'{gap}', -1), regexp_extract_all({text}, r'{gap}', 0), "
        "(p, g) -> struct(p AS piece, length(p) + coalesce(length(g), 0) AS size))"
    )


def _head(piece: Column) -> Column:
    """The section that a piece is the heading of, null if it is none."""
    heading = F.trim(F.upper(strip(piece)), F.lit(" :-"))
    begins = F.upper(F.substring(F.ltrim(piece, F.lit(BLANK + ":-")), 1, 4))  # most pieces don't begin like any
    names = F.create_map(*[F.lit(x) for pair in SECTIONS.items() for x in pair])
    # nor like the first letter of any, or what stands before one; so far nothing is counted or copied
    some = (piece < "!") | (piece >= "\x7f")
    for ch in sorted({c for name in SECTIONS for c in (name[0], name[0].lower())} | set(":-")):
        some = some | F.startswith(piece, F.lit(ch))
    return F.when(some & begins.isin(*sorted({name[:4] for name in SECTIONS})), F.element_at(names, heading))


def unit_texts(text: Column, long: int = LONG) -> Column:
    """The texts of a text's units, in order: units' rows without offsets and sections, so without windows; the n-th is unit n."""

    def pieces(block: Column) -> Column:
        return F.when((F.octet_length(block) > long) & (F.length(block) > long), F.split(block, SENTENCE_GAP, -1)).otherwise(F.array(block))

    blocks = F.filter(F.split(F.coalesce(text, F.lit("")), BLOCK_GAP, -1), lambda b: _head(b).isNull())
    return F.filter(F.transform(F.flatten(F.transform(blocks, pieces)), strip_some), lambda u: u != "")


def _placed(pieces: Column, at: Column, section: Column) -> Column:
    """array<struct<piece, head, at, section>> of an array<struct<piece, size, head>>: where each piece begins, the first one at at, and the last heading so far.

    Arrays grow by a copy for each element, so shares of SHARE pieces are placed by themselves, behind the sums of the shares before them.
    """
    one, share = "struct<piece:string,head:string,at:int,section:string>", "struct<xs:array<struct<piece:string,size:int,head:string>>,at:int,section:string>"

    def run(xs: Column, first: Column, under: Column, kind: str, size: Callable, head: Callable, made: Callable) -> Column:
        def step(s: Column, x: Column) -> Column:
            below = F.coalesce(head(x), s["section"])
            return F.struct((s["at"] + size(x)).cast("int").alias("at"), below.alias("section"), F.concat(s["out"], F.array(made(x, s["at"], s["section"], below))).alias("out"))

        zero = F.struct(first.cast("int").alias("at"), under.alias("section"), F.expr(f"cast(array() as array<{kind}>)").alias("out"))
        return F.aggregate(xs, zero, step, lambda s: s["out"])

    def within(xs: Column, first: Column, under: Column) -> Column:
        made = lambda x, at_, _, below: F.struct(x["piece"].alias("piece"), x["head"].alias("head"), at_.alias("at"), below.alias("section"))
        return run(xs, first, under, one, lambda x: x["size"], lambda x: x["head"], made)

    def by_shares(xs: Column) -> Column:
        shares = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / SHARE).cast("int")), lambda k: F.slice(xs, k * SHARE + 1, SHARE))
        total = lambda s: F.aggregate(s, F.lit(0), lambda n, x: (n + x["size"]).cast("int"))
        last = lambda s: F.aggregate(s, F.lit(None).cast("string"), lambda h, x: F.coalesce(x["head"], h))
        made = lambda s, at_, above, _: F.struct(s.alias("xs"), at_.alias("at"), above.alias("section"))
        return F.flatten(F.transform(run(shares, at, section, share, total, last, made), lambda s: within(s["xs"], s["at"], s["section"])))

    return F.when(F.size(pieces) > SHARE, by_shares(pieces)).otherwise(within(pieces, at, section))


def unit_places(text: Column, long: int = LONG) -> Column:
    """array<struct<start, end, text, section>>: the units of a text, in order, as units has them, made within its row: nothing is dealt or sorted."""

    def pieces(value: Column, gap: str, head: Callable[[Column], Column]) -> Column:
        gaps = F.regexp_extract_all(value, F.lit(gap), F.lit(0))
        sized = F.zip_with(F.split(value, gap, -1), gaps, lambda p, g: F.struct(p.alias("piece"), (F.length(p) + F.coalesce(F.length(g), F.lit(0))).alias("size")))
        return F.transform(sized, lambda x: F.struct(x["piece"].alias("piece"), x["size"].alias("size"), head(x["piece"]).alias("head")))

    def sentences(b: Column) -> Column:
        whole = F.array(F.struct(b["piece"].alias("piece"), F.lit(None).cast("string").alias("head"), b["at"].alias("at"), b["section"].alias("section")))
        split = let(pieces(b["piece"], SENTENCE_GAP, lambda _: F.lit(None).cast("string")), lambda xs: _placed(xs, b["at"], b["section"]))
        return F.when((F.octet_length(b["piece"]) > long) & (F.length(b["piece"]) > long), split).otherwise(whole)

    def bare(x: Column) -> Column:
        start = x["at"] + F.length(x["piece"]) - F.length(F.ltrim(x["piece"], F.lit(BLANK)))
        return let(strip_some(x["piece"]), lambda t: F.struct(start.cast("int").alias("start"), (start + F.length(t)).cast("int").alias("end"), t.alias("text"), x["section"].alias("section")))

    blocks = let(pieces(F.coalesce(text, F.lit("")), BLOCK_GAP, _head), lambda xs: _placed(xs, F.lit(0), F.lit(FIRST_SECTION)))
    parts = F.flatten(F.transform(F.filter(blocks, lambda b: b["head"].isNull()), sentences))
    return F.filter(F.transform(parts, bare), lambda u: u["text"] != "")


def units(df: DataFrame, key: list[str], text: str = "decisao", long: int = LONG, marks: Callable[[Column, Column], dict[str, Column]] | None = None, every: bool = False, ascii_words: bool = False) -> DataFrame:
    """key, unit_id, start, end, text, section, rejected: a row for each unit; key tells the texts apart.

    Offsets are code points, end exclusive. One exchange by key serves all windows. marks: further columns made of a unit's
    text, its normalized text and of key, null where the unit is rejected; texts are normalized only if that is asked for.
    every: the piece that a text begins with has a row in any case, with an empty text where it is no unit. ascii_words: see noise.rejection.
    """
    by = Window.partitionBy(*key).orderBy("_b")
    so_far = by.rowsBetween(Window.unboundedPreceding, -1)
    blocks = df.select(*key, F.coalesce(text, F.lit("")).alias("_t")).select(*key, F.posexplode(_pieces("_t", BLOCK_GAP)).alias("_b", "_p"))
    blocks = blocks.withColumn("_at", F.coalesce(F.sum("_p.size").over(so_far), F.lit(0)))
    blocks = blocks.withColumn("_head", _head(F.col("_p.piece")))
    section = F.coalesce(F.last("_head", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0)), F.lit(FIRST_SECTION))
    blocks = blocks.withColumn("section", section)
    if every:
        blocks = blocks.where("_head IS NULL OR _b = 0").withColumn("_block", F.when(F.col("_head").isNull(), F.col("_p.piece")).otherwise(""))
    else:
        blocks = blocks.where(F.col("_head").isNull()).withColumn("_block", F.col("_p.piece"))
    split = F.when(F.length("_block") > long, _pieces("_block", SENTENCE_GAP)).otherwise(
        F.array(F.struct(F.col("_block").alias("piece"), F.length("_block").alias("size")))
    )
    parts = blocks.select(*key, "_b", "_at", "section", F.posexplode(split).alias("_s", "_q"))
    inner = Window.partitionBy(*key, "_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_from", F.col("_at") + F.coalesce(F.sum("_q.size").over(inner), F.lit(0)))
    bare = strip_some(F.col("_q.piece"))
    lead = F.length("_q.piece") - F.length(F.ltrim("_q.piece", F.lit(BLANK)))
    found = parts.withColumn("text", bare).where("text <> '' OR _b = 0 AND _s = 0" if every else "text <> ''").withColumn("start", (F.col("_from") + lead).cast("int"))
    found = found.withColumns({"_n": normalize(F.col("text")), "_low": F.lower("text")})
    # judged below the window, so that a filter on rejected isn't pushed down and worked out twice; of rejected units nothing more is asked
    more = marks(F.col("text"), F.col("_n")) if marks else {}
    found = found.withColumn("rejected", rejection(F.col("text"), F.col("_low"), ascii_words)).withColumns({name: F.when(F.col("rejected").isNull(), mark) for name, mark in more.items()})
    number = F.row_number().over(Window.partitionBy(*key).orderBy("start"))
    if every:
        number = F.count_if(F.col("text") != "").over(Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, 0))
    return found.select(
        *key,
        F.format_string("U%04d", number).alias("unit_id"),
        "start",
        (F.col("start") + F.length("text")).cast("int").alias("end"),
        "text",
        "section",
        "rejected",
        *more,
    )


def unit_lists(df: DataFrame, key: list[str], text: str = "decisao", long: int = LONG, marks: Callable[[Column, Column], dict[str, Column]] | None = None, every: bool = False, ascii_words: bool = False) -> DataFrame:
    """key, units: the units of each text as one array in order; with marks also marked, the same units with their marks. every: also of texts without units, empty."""
    rows = units(df, key, text, long, marks, every, ascii_words)
    one = F.struct("start", "unit_id", "end", "text", "section", *rows.columns[rows.columns.index("rejected") :])
    listed = rows.groupBy(*key).agg(F.array_sort(F.collect_list(F.when(F.col("text") != "", one) if every else one)).alias("_u"))
    return listed.select(*key, *([F.col("_u").alias("marked")] if marks else []), F.expr(f"cast(transform(_u, u -> struct(u.unit_id, u.start, u.end, u.text, u.section, u.rejected)) as array<{UNIT}>)").alias("units"))


def reconstruct_sql(source: str, ids: str, units_: str) -> str:
    """SQL: the text of the units with these ids: verbatim from first to last if they (nearly) touch, else line by line."""
    chosen = f"array_sort(transform(filter({units_}, u -> array_contains({ids}, u.unit_id)), u -> struct(u.start AS start, u.end AS end, u.text AS text)))"
    gap = f"substring({source}, a.end + 1, b.start - a.end)"
    apart = f"exists(zip_with(slice(c, 1, size(c) - 1), slice(c, 2, size(c)), (a, b) -> b.start - a.end > {NEAR} AND regexp_replace({gap}, r'{WS}+', '') <> ''), x -> x)"
    whole = f"substring({source}, element_at(c, 1).start + 1, element_at(c, -1).end - element_at(c, 1).start)"
    return (
        f"element_at(transform(array({chosen}), c -> CASE WHEN size(c) = 0 THEN '' WHEN size(c) > 1 AND {apart} "
        f"THEN array_join(transform(c, x -> x.text), '\n') ELSE {whole} END), 1)"
    )


def reconstruct(source: str, ids: str, units_: str) -> Column:
    return F.expr(reconstruct_sql(source, ids, units_))
