"""Column functions over text: accent folding, slugs, class families, hashes and stable splits."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str sees it: code points (Java's Unicode \s lacks the four separators, and is slow), as a class and as text.
SPACES = (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def _class(codes: list[int]) -> str:
    """A pattern's class of code points, as ranges."""
    ranges: list[list[int]] = []
    for c in codes:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "[" + "".join(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]"


WS = _class(list(SPACES))
#: What is left of it in folded texts: ASCII's, one by one, as Java looks characters up that are listed but tries ranges in turn; and the others.
ASCII_WS = "[" + "".join(f"\\x{c:02x}" for c in SPACES if c < 128) + "]"
_WIDE_WS = "".join(chr(c) for c in SPACES if c >= 128 and unicodedata.normalize("NFKD", chr(c)) == chr(c))
BLANK = "".join(map(chr, SPACES))
FLAGS = "(?isUd)"


def java(pattern: str) -> str:
    """A pattern with white space as WS has it."""
    out = pattern.replace(r"\S", "\0").replace(r"\s", WS)
    return out.replace("\0", f"[^{WS[1:]}")


def _fold(ch: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c)).casefold()


def plain(text: str | None) -> str:
    """normalize() of one text on the driver, as headings need it."""
    return " ".join(_fold(text or "").split())


#: Hangul syllables fold by arithmetic: one of 19 first, 21 middle and 27 last letters (or no last one).
HANGUL, HANGUL_END, LEADS, VOWELS, TAILS = 0xAC00, 0xD7A3, 0x1100, 0x1161, 0x11A7
_LATIN = 0x24F


@lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, dict[str, str]]:
    """(from, to, several): characters that fold to one other or, at the end of from, to none; those that fold to several. Hangul syllables are in none of them."""
    one, none, several = {}, [], {}
    for code in range(0x41, sys.maxunicode + 1):
        if HANGUL <= code <= HANGUL_END or 0xD800 <= code <= 0xDFFF:
            continue
        ch = chr(code)
        to = _fold(ch)
        if to == ch:
            continue
        if len(to) == 1:
            one[ch] = to
        elif to:
            several[ch] = to
        else:
            none.append(ch)
    return "".join(one) + "".join(none), "".join(one.values()), several


def fold_map() -> tuple[str, str, dict[str, str]]:
    """fold_tables() for replacing by plain text functions: of those that fold to several only those below U+0250, the ellipsis and Latin ligatures."""
    src, dst, several = fold_tables()
    return src, dst, {ch: to for ch, to in several.items() if ord(ch) <= _LATIN or ch == "\u2026" or "\ufb00" <= ch <= "\ufb06"}


#: Where characters that fold to several stand, above _LATIN; coarse but for punctuation, so that the pattern is short.
_COARSE = r"\x{300}-\x{1fff}\x{2080}-\x{2fff}\x{3200}-\x{33ff}\x{ac00}-\x{d7a3}\x{f900}-\x{fffd}\x{10000}-\x{10ffff}"


@lru_cache(maxsize=1)
def _several() -> tuple[str, str, str]:
    """Patterns of the texts that have a common character that folds to several (those of fold_map), and that may have another; and the table of the
    others: each behind a U+0001, with what it folds to behind it."""
    _, _, common = fold_map()
    rare = {ch: to for ch, to in fold_tables()[2].items() if ch not in common}
    coarse = re.compile("[" + re.sub(r"\\x{([0-9a-f]+)}", lambda m: chr(int(m[1], 16)), _COARSE) + "]")
    fine = _class([ord(c) for c in rare if not coarse.match(c)])[:-1] + _COARSE + "]"
    return r"(?=[^\x00-\x7f])[" + "".join(common) + "]", f"(?=[^\\x{{0}}-\\x{{{_LATIN:x}}}]){fine}", "".join(f"\x01{ch}{to}" for ch, to in rare.items()) + "\x01"


def _spread(c: Column) -> Column:
    """Each character that folds to several, and each Hangul syllable, as what it folds to; the others as they are.

    Two stages: what stands behind a character in the table, and of that what it folds to.
    """
    table = F.lit(_several()[2])

    def letters(first: int, n: int) -> Column:
        return F.split(F.lit(",".join(chr(first + k) for k in range(n))), ",")

    def syllable(at: Column) -> Column:
        tail = F.when(at % 28 > 0, F.get(letters(TAILS, 28), at % 28)).otherwise("")
        return F.concat(F.get(letters(LEADS, 19), F.floor(at / 588).cast("int")), F.get(letters(VOWELS, 21), F.floor(at % 588 / 28).cast("int")), tail)

    def listed(ch: Column) -> Column:
        rest = F.call_function("substring_index", table, F.concat(F.lit("\x01"), ch), F.lit(-1))  # all of it, so nothing below, where ch isn't there
        behind = F.substring_index(rest, "\x01", 1)
        return F.coalesce(F.nullif(behind, F.lit("")), ch)

    def one(ch: Column) -> Column:
        code = F.ascii(ch)
        return F.when(code < 128, ch).when((code >= HANGUL) & (code <= HANGUL_END), syllable(code - HANGUL)).otherwise(listed(ch))

    return F.array_join(F.transform(F.split(c, ""), one), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out, and stands in the plan, once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def fold(c: Column, spaces: str = "") -> Column:
    """Without accents and case: each character's NFKD, less combining marks, case-folded; null is empty.

    ASCII texts are only lower-cased. Common characters that fold to several, as in German, are replaced; only texts that have others
    are taken apart, character by character. spaces: characters that become a space, too.
    """
    src, dst, common = fold_map()
    src, dst = spaces + src, " " * len(spaces) + dst
    often, seldom, _ = _several()
    c = _text(c)
    replaced = c
    for ch, to in common.items():
        replaced = F.replace(replaced, F.lit(ch), F.lit(to))
    some = F.when(F.rlike(c, F.lit(seldom)), _spread(replaced)).when(F.rlike(c, F.lit(often)), replaced).otherwise(c)
    return F.when(F.rlike(c, F.lit(r"[^\x00-\x7f]")), F.translate(some, src, dst)).otherwise(F.lower(c))


def lengthens(c: Column) -> Column:
    """Whether c may have characters that fold to several."""
    often, seldom, _ = _several()
    return F.rlike(c, F.lit(r"[^\x00-\x7f]")) & (F.rlike(c, F.lit(often)) | F.rlike(c, F.lit(seldom)))


def strip(c: Column) -> Column:
    """Without white space at either end (of any kind, unlike trim)."""
    return F.btrim(c, F.lit(BLANK))


def is_blank(c: Column) -> Column:
    """strip(c) == "", by the first characters that aren't white space alone."""
    return F.ltrim(c, F.lit(BLANK)) == ""


def strip_some(c: Column) -> Column:
    """strip(c) for a c that costs nothing to name again, a column or a lambda's: most have ASCII at both ends, which is seen without taking them apart."""
    last = F.substring(c.cast("binary"), -1, 1)
    bare = (c >= "!") & (c < "\x7f") & (last >= F.lit(b"!")) & (last < F.lit(b"\x7f"))
    return F.when(bare, c).otherwise(strip(c))


def one_space(c: Column) -> Column:
    """c with runs of ASCII white space as one space and none at the ends."""
    return F.trim(F.regexp_replace(c, f"{ASCII_WS}+", " "))


def normalize(c: Column) -> Column:
    """fold, with runs of white space as one space and none at the ends."""
    return one_space(fold(c, _WIDE_WS))


#: Characters outside Latin-1 that stand together, this many at least, and fold to nothing that matters are listed as harmless.
_RUN = 128
#: Characters of folded texts, the rarest first; and how many follow, at least, where a part is looked for by a rare one.
_RARE, _TAIL = "xjkwqz(-gbfyhv", 7


@lru_cache(maxsize=None)
def unfolded(parts: tuple[str, ...]) -> tuple[str, tuple[str, ...], tuple[str, ...]]:
    """(odd, patterns, hints): a pattern for each part, which finds in texts as they are what normalized texts contain, and a pattern of the characters whose
    texts have to be normalized to tell: they fold to none, to several that meet a part, or are letters outside Latin-1. A part's hint is what its pattern
    ends with, from a rare character on: it is found faster, and where it isn't, the part isn't either.

    Parts are ASCII, with single spaces and none at their ends. ß is the one character that is taken for several, at a part's ends for half of them.
    """
    src, dst, several = fold_tables()
    single = dict(zip(src, dst))
    used = set("".join(parts)) - {" "}

    def meets(to: str) -> bool:
        return " " in to or any(to in p or p in to or any(p.startswith(to[k:]) or p.endswith(to[:k]) for k in range(1, len(to))) for p in parts)

    odd = {ord(c) for c in src[len(dst) :]} | {ord(c) for c, to in single.items() if ord(c) > 255 and to in used}
    odd |= {ord(c) for c, to in several.items() if c != "ß" and meets(to)}
    harmless, begin = [c for c in range(256) if c not in odd], 256
    for c in [*sorted(c for c in odd if 255 < c < 0xD800), 0xD800]:
        harmless += range(begin, c) if c - begin >= _RUN else ()
        begin = c + 1
    spaces = sorted({*SPACES, *(ord(c) for c, to in single.items() if to == " ")})

    def one(ch: str, more: str = "") -> str:
        same = [ord(c) for c in map(chr, range(256)) if single.get(c, c) == ch and c not in several]
        near, far = ([c for c in spaces if c < 256], _class([c for c in spaces if c > 255])[1:-1]) if ch == " " else ([*same, *map(ord, more)], "")
        listed = "".join(f"\\x{c:02x}" for c in near)  # one by one, as in ASCII_WS
        return f"(?:[{listed}]|[{far}])+" if far else f"[{listed}]"

    def pattern(part: str) -> str:
        last = len(part) - 1
        each = [one(ch, "ß" if ch == "s" and k in (0, last) else "") for k, ch in enumerate(part)]
        twice = one("s") * 2
        return "".join(each).replace(twice, f"(?:{twice}|ß)")

    def hint(part: str) -> str:
        return pattern(part[min(range(max(1, len(part) - _TAIL)), key=lambda k: _RARE.find(part[k]) % 99) :])

    return f"[^{_class(harmless)[1:]}", tuple(map(pattern, parts)), tuple(map(hint, parts))


def starts(c: Column, pattern: str, flags: str = "") -> Column:
    """Whether c begins with what a pattern, never empty, matches: unlike rlike of ^, nothing behind the first place is tried."""
    return F.regexp_extract(c, f"{flags}^(?:({pattern})|)", 1) != ""


def slug(c: Column, size: int = 80, normalized: bool = False) -> Column:
    """a-z and 0-9 joined by underscores, cut to size; "na" if nothing is left."""
    n = c if normalized else normalize(c)
    bare = F.regexp_replace(F.regexp_replace(n, "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(F.substring(bare, 1, size), F.lit("")), F.lit("na"))


#: Class families by what the normalized class contains, in order.
FAMILIES = (
    ("mandado de seguranca", "mandado_seguranca"),
    ("cumprimento de sentenca", "cumprimento_sentenca"),
    ("procedimento comum", "procedimento_comum"),
    ("execucao fiscal", "execucao_fiscal"),
    ("agravo", "agravo"),
    ("embargos", "embargos"),
)


def first_of(cases: list[tuple[Column, Column | str]], otherwise: Column | str | None = None) -> Column:
    """The value of the first condition that holds."""
    out = None
    for condition, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out if otherwise is None else out.otherwise(otherwise)


def any_in(c: Column, parts: tuple[str, ...]) -> Column:
    """Whether c contains one of the parts: one pattern, whose code stays small however many there are."""
    return F.contains(c, F.lit(parts[0])) if len(parts) == 1 else F.rlike(c, F.lit("|".join(map(re.escape, parts))))


def class_family(c: Column) -> Column:
    return let(normalize(c), lambda n: first_of([(F.contains(n, F.lit(part)), name) for part, name in FAMILIES], slug(n, 50, normalized=True)))


def is_tax_foreclosure(c: Column) -> Column:
    return F.contains(normalize(c), F.lit("execucao fiscal"))


def text_hash(c: Column) -> Column:
    return F.sha2(_text(c), 256)


def stable_split(c: Column) -> Column:
    """train, val or test (80, 10 and 10 in 100) by the text's hash."""
    point = F.conv(F.substring(F.sha2(_text(c), 256), 1, 8), 16, 10).cast("long") % 100
    return first_of([(point < 80, "train"), (point < 90, "val")], F.lit("test"))
