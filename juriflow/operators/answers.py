"""Reading a model's answers as columns: JSON wherever it stands, tolerated shapes, selections checked against the units.

An answer becomes a VARIANT; everything about it is then paths, casts and higher-order functions, so that no row is
taken to Python and the rows' other columns stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from juriflow.functions.constants import CATEGORIES
from juriflow.functions.text import BLANK, FLAGS, WS, any_in, java, let, normalize, strip

# Words by which orders, tutelary and expert measures are told.
ORDER_PARTS = ("determino", "defiro", "indefiro", "condeno", "fixo", "homologo", "intime", "proceda", "promova", "adote", "observe", "considere")
TUTELA_PARTS = ("tutela", "liminar", "cautelar", "efeito suspensivo", "suspendo", "suspensao")
EXPERT_PARTS = ("habilit", "assistente tecnico", "perito", "pericia")
LIST_ITEM = r"^(?:[a-z]\)|\d+[.)])\s+"
SELECTED = "array<struct<rank:int,unit_ids:array<string>,category:string,priority:int,reason:string>>"
#: A JSON text that is one string, number or word.
_SCALAR = r'^(?:"(?:[^"\\\x00-\x1f]|\\.)*"|-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null|NaN|-?Infinity)$'
_REASON = 300


def bare(text: Column) -> Column:
    """An answer without white space and code fences around it; null is empty."""
    inner = F.regexp_replace(strip(F.coalesce(text, F.lit(""))), f"(?i)^```(?:json)?{WS}*|{WS}*```\\z", "")
    return strip(inner)


def value(text: Column) -> Column:
    """The JSON value (VARIANT) of a bare answer: all of it, or the first that begins at some bracket, whatever follows; null where there is none.

    Each bracket is tried in turn only as long as none has given a value.
    """
    starts = F.filter(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, F.lit(1)).isin("[", "{"))
    tried = F.aggregate(
        starts, F.lit(None).cast("variant"), lambda found, i: F.when(found.isNotNull(), found).otherwise(F.try_parse_json(F.substring(text, i, F.length(text))))
    )
    whole = F.rlike(text, F.lit(_SCALAR))
    return F.when(text == "", F.lit(None).cast("variant")).when(whole, F.try_parse_json(text)).otherwise(tried)


def _kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, VOID and so on; null where there is no value."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _at(v: Column, field: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, f"$.{field}", kind)


def items(text: Column) -> tuple[Column, Column, Column]:
    """(selections as VARIANTs, how they were given, error) of an answer; one of the last two is null."""
    b = bare(text)
    return _items(b, value(b))


def _items(b: Column, v: Column) -> tuple[Column, Column, Column]:
    given = _at(v, "selected")
    kind, inner = _kind(v), _kind(given)
    listed = kind == "ARRAY"
    objects = F.when(listed, F.try_variant_get(v, "$", "array<variant>")).when(inner == "OBJECT", F.array(given)).when(inner == "ARRAY", F.try_variant_get(given, "$", "array<variant>"))
    objects = F.filter(F.coalesce(objects, F.array().cast("array<variant>")), lambda x: _kind(x) == "OBJECT")
    error = (
        F.when(b == "", "empty answer").when(v.isNull(), "answer without JSON").when(~kind.isin("ARRAY", "OBJECT"), F.concat(F.lit("unexpected JSON type: "), F.lower(kind)))
        .when((kind == "OBJECT") & given.isNotNull() & ~inner.isin("VOID", "OBJECT", "ARRAY"), "selected is not a list")
    )
    note = F.when(error.isNull(), F.when(listed, "top_level_list").when(inner == "OBJECT", "selected_object:single_object_wrapped").otherwise("selected_object"))
    return F.when(error.isNull(), objects), note, error


def is_list_item(text: Column) -> Column:
    return F.rlike(F.ltrim(F.coalesce(text, F.lit("")), F.lit(BLANK)), F.lit(FLAGS + java(LIST_ITEM)))


def is_main_order(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.endswith(F.rtrim(text, F.lit(BLANK)), F.lit(":")) & any_in(normalize(text), ORDER_PARTS)


def ids_of(item: Column) -> Column:
    """The ids that a selection gives: a text, or the texts of a list; null where it gives anything else."""
    given = _at(item, "unit_ids")
    texts = F.filter(F.try_variant_get(given, "$", "array<variant>"), lambda x: _kind(x) == "STRING")
    one = F.try_variant_get(given, "$", "string")
    return F.when(_kind(given) == "STRING", F.array(one)).when(_kind(given) == "ARRAY", F.transform(texts, lambda x: F.try_variant_get(x, "$", "string")))


def with_parent(ids: Column, units: Column) -> Column:
    """The visible units with these ids, in the text's order, led by the order that the first of them, a list item, completes."""
    own = F.filter(units, lambda u: u["rejected"].isNull() & F.array_contains(ids, u["unit_id"]))
    first = F.array_position(F.transform(units, lambda u: u["unit_id"]), F.get(own, F.lit(0))["unit_id"]).cast("int")  # from 1
    before = F.filter(F.slice(units, F.greatest(F.lit(1), first - 1), F.lit(1)), lambda u: u["rejected"].isNull() & is_main_order(u["text"]))
    led = (F.size(own) > 0) & (first > 1) & is_list_item(F.get(own, F.lit(0))["text"])
    return F.when(led, F.concat(before, own)).otherwise(own)


def fitting_category(category: Column, text: Column) -> Column:
    """tutela only where the text speaks of one; measures about experts are orders."""
    wrong = let(normalize(text), lambda n: ~any_in(n, TUTELA_PARTS) & any_in(n, EXPERT_PARTS))
    return F.when((category == "tutela") & wrong, "ordem_determinacao").otherwise(category)


def priority_of(item: Column) -> Column:
    """1 to 4: numbers without their fractions, texts that are whole numbers; 3 for anything else."""
    given = _at(item, "priority")
    kind, text = _kind(given), F.try_variant_get(given, "$", "string")
    digits = F.regexp_replace(text, r"[^0-9]|^[^1-9]*", "")
    whole = F.rlike(text, F.lit(rf"^{WS}*[+-]?[0-9]+(?:_[0-9]+)*{WS}*\z"))
    from_text = F.when(~whole, 3).when(F.contains(text, F.lit("-")), 1).when(F.length(digits) > 3, 4).otherwise(F.coalesce(digits.try_cast("int"), F.lit(0)))
    number = F.try_variant_get(given, "$", "double")
    from_number = F.when(number >= 4, 4).when(number < 2, 1).otherwise(number.cast("int"))
    got = F.when(kind == "STRING", from_text).when(kind.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), from_number).when(kind == "BOOLEAN", 1)
    return F.greatest(F.lit(1), F.least(F.lit(4), F.coalesce(got, F.lit(3)))).cast("int")


def reason_of(item: Column) -> Column:
    """A short reason; what isn't text is shown as JSON, but words as Python has them."""
    given = _at(item, "reason")
    kind, text = _kind(given), F.try_variant_get(given, "$", "string")
    shown = F.when(kind == "STRING", text).when(kind == "VOID", "None").when(kind == "BOOLEAN", F.initcap(text)).otherwise(F.to_json(given))
    return F.substring(F.coalesce(F.when(given.isNotNull(), shown), F.lit("")), 1, _REASON)


def read(answers: DataFrame, most: int, answer: str = "answer", units: str = "units") -> DataFrame:
    """answers with selected (SELECTED), note and error: what the answer selects of its units; selected is null where it can't be read.

    Selections have visible ids, a known category, a priority of 1 to 4 and a short reason; none twice, `most` at most.
    """
    staged = answers.withColumn("_bare", bare(F.col(answer)))
    staged = staged.withColumn("_value", value(F.col("_bare")))
    found, note, error = _items(F.col("_bare"), F.col("_value"))
    staged = staged.withColumns({"_items": found, "note": note, "error": error})
    held = F.coalesce(F.col(units), F.array().cast(staged.schema[units].dataType))

    def one(item: Column) -> Column:
        kind = _kind(_at(item, "category"))
        return F.struct(
            with_parent(F.coalesce(ids_of(item), F.array().cast("array<string>")), held).alias("units"), F.when(kind == "STRING", _at(item, "category", "string")).alias("category"),
            priority_of(item).alias("priority"), reason_of(item).alias("reason"),
        )

    staged = staged.withColumn("_read", F.transform("_items", one))

    def fitted(x: Column) -> Column:
        text = F.array_join(F.transform(x["units"], lambda u: u["text"]), "\n")
        ids = F.transform(x["units"], lambda u: u["unit_id"])
        return F.struct(ids.alias("unit_ids"), fitting_category(x["category"], text).alias("category"), x["priority"].alias("priority"), x["reason"].alias("reason"))

    staged = staged.withColumn("_good", F.transform(F.filter("_read", lambda x: (F.size(x["units"]) > 0) & x["category"].isin(*CATEGORIES)), fitted))
    again = "exists(slice(_good, 1, i), y -> y.unit_ids = x.unit_ids AND y.category = x.category)"
    once = F.expr(f"slice(filter(_good, (x, i) -> NOT {again}), 1, {int(most)})")
    staged = staged.withColumn("_once", once)
    ranked = F.expr(
        "transform(_once, (x, i) -> struct(i + 1 AS rank, x.unit_ids AS unit_ids, x.category AS category, x.priority AS priority, x.reason AS reason))"
    ).cast(SELECTED)
    return staged.withColumn("selected", ranked).drop("_bare", "_value", "_items", "_read", "_good", "_once")


