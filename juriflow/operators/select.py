"""Deterministic selection of units: categories, operative openings, rule scores."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from juriflow.functions.text import any_in, first_of, let, normalize, starts
from juriflow.operators.noise import rejection

# Categories by what the normalized text contains, in order.
CATEGORY_PARTS = (
    (("julgo", "homologo", "declaro", "rejeito", "extingo", "acolho"), "resultado_julgamento"),
    (("honorario", "custas"), "honorarios_custas"),
    (("prescri", "decaden"), "prescricao_decadencia"),
    (("intim", "notifi", "cit", "vista"), "intimacao_manifestacao"),
    (("arquiv", "remeta", "conclus"), "recurso_proximo_passo"),
    (("requisit", "pagamento", "precatorio", "rpv"), "restituicao_pagamento"),
)
OTHER_CATEGORY = "ordem_determinacao"
# Fixed value: how an operative sentence begins, in normalized text.
OPERATIVE = (
    r"^(?:\d+[.)]\s*)?(?:(?:diante|ante) do exposto[,;:]?\s*|isto posto[,;:]?\s*|por tais fundamentos[,;:]?\s*)?"
    r"(?:determino|defiro|indefiro|julgo|homologo|declaro|rejeito|condeno|extingo|acolho|"
    r"intime-se|intimem-se|notifique-se|cite-se|arquive-se|arquivem-se|remeta-se|remetam-se|"
    r"expeca-se|proceda|procedam|aguarde-se|mantenha-se|libere-se|suspenda-se|"
    r"ficam? as partes intimadas|vistas? (?:a|as|ao))\b"
)
#: OPERATIVE matches at most 50 characters behind leading digits; a start of START characters with ENOUGH that are no digits shows whether it does.
START, ENOUGH = 120, 60
_WORDS = re.findall(r"[a-z]{3}[a-z-]*", OPERATIVE)
#: What nothing begins with that OPERATIVE matches, before or after normalizing: other five or three letters, a word of one or two (one with an accent), a mark,
#: a number with something else behind it.
_OTHERS = "|".join(f"(?!(?i:{'|'.join(sorted({word[:n] for word in _WORDS}))}))[A-Za-z]{{{n}}}" for n in (5, 3)) + "|(?:[A-Za-z]{1,2}|[À-ÖØ-öø-ÿ])[ -@\\[-`{-~]|[!-/:-@\\[-`{-~]|[0-9]++[ -(*--/:-~]"
# Fixed values of the score: label part, parts the whole text must have, parts of which text or opening must have one, points.
LABEL_POINTS = (
    ("requisitorio", ("n", ("requisit",)), ("n", ("intim", "manifest", "pagamento", "exped")), 8),
    ("contrarrazo", ("n", ("contrarrazo",)), ("n", ("intim", "manifest")), 8),
    ("citacao", None, ("h", ("cite-se", "citacao", "cita", "intim")), 8),
    ("ato ordinatorio", None, ("h", ("intim", "vista", "prazo", "arquiv")), 6),
    ("sobrestamento", None, ("h", ("sobrest",)), 8),
    ("prescricao", ("h", ("prescri",)), ("h", ("declaro", "julgo", "reconhe")), 8),
    ("sentenca", None, ("h", ("julgo", "homologo", "declaro", "extingo", "rejeito", "acolho", "condeno")), 8),
)
NARRATIVE = ("sustenta ", "alega ", "a parte sustenta ", "a impetrante sustenta ", "a autora sustenta ")
PAST = ("foi devidamente notificada", "culminou no ato declaratorio")
OPENING = 180
OPENING_REASON = "deterministic rules fallback"


def category(normalized: Column) -> Column:
    return first_of([(any_in(normalized, parts), name) for parts, name in CATEGORY_PARTS], F.lit(OTHER_CATEGORY))


def operative(normalized: Column) -> Column:
    return starts(normalized, OPERATIVE)


def opens(text: Column, start: Column | None = None) -> Column:
    """operative(normalize(text)), by the text's start where that has enough letters to tell. start: the first START characters, if that is a column."""
    start = F.substring(text, 1, START) if start is None else start
    open_ = (start != text) & ~starts(start, f"(?:[^!-/:-~]*+[!-/:-~]){{{ENOUGH}}}")
    return ~starts(start, _OTHERS) & operative(normalize(F.when(open_, text).otherwise(start)))


def fallback_score(normalized: Column, label: Column, opening: Column | None = None) -> Column:
    """How likely a unit is the act that a rule's (normalized) label names; 0 for narrative. opening: how the unit begins, if that is a column."""
    texts = {"n": normalized, "h": F.substring(normalized, 1, OPENING) if opening is None else opening}
    score = F.when(operative(normalized), 4).otherwise(0)
    for part, must, one_of, points in LABEL_POINTS:
        holds = F.contains(label, F.lit(part)) & any_in(texts[one_of[0]], one_of[1])
        if must:
            holds = holds & any_in(texts[must[0]], must[1])
        score = score + F.when(holds, points).otherwise(0)
    told = F.lit(False)
    for start in NARRATIVE:
        told = told | F.startswith(normalized, F.lit(start))
    return first_of([(told, F.lit(0)), (any_in(texts["h"], PAST), F.greatest(F.lit(0), score - 6))], score)


def _items(units: Column, priority: int, reason: Column) -> Column:
    """Selections, in order, of an array of units."""
    return F.transform(
        units,
        lambda u, i: F.struct(
            (i + 1).cast("int").alias("rank"), F.array(u["unit_id"]).alias("unit_ids"), let(normalize(u["text"]), category).alias("category"), F.lit(priority).alias("priority"), reason.alias("reason")
        ),
    )


def marks(mode: str) -> Callable[[Column, Column], dict[str, Column]]:
    """What opening_items and rule_items ask of a unit: act, or score (by a key column label, the normalized label of the text's rule)."""
    if mode == "rules":
        return lambda text, n: {"act": opens(text)}
    return lambda text, n: {"score": fallback_score(n, F.col("label"), F.substring(n, 1, OPENING))}


def opening_items(marked: Column, most: int = 3) -> Column:
    """The first operative units of a text, as selections.

    With most <= 0 the first kept unit is still taken if it is operative, as the limit is looked at behind each unit.
    """
    live = F.filter(marked, lambda u: u["rejected"].isNull())
    if most <= 0:
        return _items(F.filter(F.slice(live, 1, 1), lambda u: u["act"]), 3, F.lit(OPENING_REASON))
    return _items(F.slice(F.filter(live, lambda u: u["act"]), 1, most), 3, F.lit(OPENING_REASON))


def first_openings(texts: Column, most: int, ascii_words: bool = False) -> Column:
    """The units (unit_id, text) that opening_items takes, for most above 0, of the texts of all units in order: only those that are operative are judged."""
    numbered = F.transform(texts, lambda t, i: F.struct((i + 1).alias("n"), t.alias("text"), F.substring(t, 1, START).alias("start")))
    live = F.filter(numbered, lambda u: opens(u["text"], u["start"]) & let(F.lower(u["text"]), lambda low: rejection(u["text"], low, ascii_words).isNull()))
    return F.transform(F.slice(live, 1, most), lambda u: F.struct(F.format_string("U%04d", u["n"]).alias("unit_id"), u["text"].alias("text")))


def opened_items(openings: Column) -> Column:
    return _items(openings, 3, F.lit(OPENING_REASON))


def _reason() -> Column:
    return F.coalesce(F.concat(F.lit("rule fallback: "), "rule_id", F.lit("/"), "rule_label"), F.lit("rule fallback conservador"))


def rule_items(marked: Column, most: int = 3) -> Column:
    """The units of the best fallback_score, as selections; beside rule_id and rule_label (null without a rule)."""
    scored = F.filter(marked, lambda u: u["rejected"].isNull() & (u["score"] > 0))
    best = F.array_sort(scored, lambda a, b: F.when(a["score"] != b["score"], F.sign(b["score"] - a["score"])).otherwise(F.sign(a["start"] - b["start"])).cast("int"))
    return _items(F.slice(best, 1, max(0, most)), 2, _reason())

