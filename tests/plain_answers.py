"""Answers read and checked in plain Python: what the columns of juriflow.operators.answers are held against."""

import json
import re
import unicodedata

from juriflow.functions.constants import CATEGORIES
from juriflow.operators.answers import EXPERT_PARTS, ORDER_PARTS, TUTELA_PARTS


class UnreadableAnswer(ValueError):
    """No selections can be read from a model's answer."""


def plain(text: str | None) -> str:
    folded = "".join(c for c in unicodedata.normalize("NFKD", text or "") if not unicodedata.combining(c)).casefold()
    return " ".join(folded.split())


def read_json(text: str | None):
    """The JSON value of an answer: all of it, without fences, or the first that begins at some bracket."""
    bare = re.sub(r"^```(?:json)?\s*|\s*```$", "", (text or "").strip(), flags=re.I).strip()
    if not bare:
        raise UnreadableAnswer("empty answer")
    try:
        return json.loads(bare)
    except ValueError:
        pass
    reader = json.JSONDecoder()
    for spot in re.finditer(r"[\[{]", bare):
        try:
            return reader.raw_decode(bare, spot.start())[0]
        except ValueError:
            continue
    raise UnreadableAnswer("answer without JSON")


def read_items(value) -> tuple[list[dict], str]:
    """Selections of an answer, and how they were given."""
    if isinstance(value, list):
        given, note = value, "top_level_list"
    elif isinstance(value, dict):
        given, note = value.get("selected", []), "selected_object"
    else:
        raise UnreadableAnswer(f"unexpected JSON type: {type(value).__name__}")
    if given is None:
        return [], note
    if isinstance(given, dict):
        given, note = [given], f"{note}:single_object_wrapped"
    if not isinstance(given, list):
        raise UnreadableAnswer("selected is not a list")
    return [x for x in given if isinstance(x, dict)], note


def is_list_item(text: str | None) -> bool:
    return re.match(r"(?:[a-z]\)|\d+[.)])\s+", (text or "").lstrip(), re.I) is not None


def is_main_order(text: str | None) -> bool:
    n = plain(text)
    return (text or "").rstrip().endswith(":") and any(p in n for p in ORDER_PARTS)


def with_parent(ids: list[str], units: list[dict]) -> list[str]:
    """Known ids once each in the text's order, led by the order that the first, a list item, completes."""
    place = {u["unit_id"]: i for i, u in enumerate(units)}
    known = sorted({x for x in ids if x in place}, key=place.get)
    if known and (i := place[known[0]]) > 0 and is_list_item(units[i]["text"]):
        before = units[i - 1]
        if before["rejected"] is None and is_main_order(before["text"]):
            known.insert(0, before["unit_id"])
    return known


def fitting_category(category: str, ids: list[str], units: list[dict]) -> str:
    """tutela only where the text speaks of one; measures about experts are orders."""
    n = plain("\n".join(u["text"] for u in units if u["unit_id"] in set(ids)))
    wrong = category == "tutela" and not any(p in n for p in TUTELA_PARTS) and any(p in n for p in EXPERT_PARTS)
    return "ordem_determinacao" if wrong else category


def validate(items: list[dict], units: list[dict], most: int) -> list[dict]:
    """Selections with visible ids, a known category, a priority of 1 to 4 and a short reason, none twice, `most` at most."""
    visible = {u["unit_id"] for u in units if u["rejected"] is None}
    out: dict[tuple, dict] = {}
    for item in items:
        ids = item.get("unit_ids", [])
        ids = [ids] if isinstance(ids, str) else ids
        category = item.get("category")
        if not isinstance(ids, list) or category not in CATEGORIES:
            continue
        ids = [x for x in with_parent([str(x) for x in ids if str(x) in visible], units) if x in visible]
        if not ids:
            continue
        category = fitting_category(category, ids, units)
        try:
            priority = int(item.get("priority", 3))
        except (TypeError, ValueError, OverflowError):
            priority = 3
        one = {"unit_ids": ids, "category": category, "priority": max(1, min(4, priority)), "reason": str(item.get("reason", ""))[:300]}
        out.setdefault((*ids, category), one)
        if len(out) >= most:
            break
    return list(out.values())


