"""Why a unit of text is noise: the first rule that matches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from juriflow.functions.text import BLANK, FLAGS, first_of, java, lengthens, normalize, starts, strip

# The patterns of each reason, in order of precedence. They hold for Java and RE2 alike; flags are added.
PATTERNS = (
    ("numeric_identifier_only", r"^\s*\d{16,}\s*$"),
    ("signature_or_timestamp", r"^\s*(?:\(assinado\s+digitalmente\)\s*)?(?:assinado\s+eletronicamente\s+por\b|documento\s+assinado\s+eletronicamente\b)"),
    ("signature_or_timestamp", r"^\s*\d{1,2}/\d{1,2}/\d{4}\s+\d{1,2}:\d{2}(?::\d{2})?\s*$"),
    ("signature_or_timestamp", r"^\s*[A-ZÁÉÍÓÚÂÊÔÃÕÇ .\-]{5,}\s*\n\s*(?:ju[ií]z|ju[ií]za|desembargador|desembargadora|t[eé]cnico|analista)\b"),
    ("location_date_boilerplate", r"^\s*[A-ZÁÉÍÓÚÂÊÔÃÕÇa-záéíóúâêôãõç .\-/]+,\s*(?:data(?:\s+e\s+hora)?\s+(?:registrad[ao]s?(?:\s+no\s+sistema)?|da assinatura)|na data da assinatura eletr[oô]nica)\.?\s*$"),
    ("url_or_electronic_identifier", r"^\s*https?://\S+\s*(?:\d{12,})?\s*$"),
    ("generic_closing_fragment", r"^\s*(?:\d+[.)]\s*)?(?:(?:intima[cç][õo]es?\s+e\s+)?provid[eê]ncias\s+necess[aá]rias|intima[cç][õo]es?\s+e\s+provid[eê]ncias\s+necess[aá]rias|intimem-se)\.?\s*$"),
    ("likely_party_request", r"^\s*(?:\(?[ivxlcdm]+\)?[\s.\-–—:]*)?(?:no mérito,\s*)?(?:requer|requer-se|pede|postula|pretende|ao final,\s*(?:requer|o reconhecimento|a declaração))\b"),
    ("historical_reference", r"\b(?:por meio de|em)\s+(?:despacho|decis[aã]o|senten[cç]a|ac[oó]rd[aã]o).*?\b(?:determinou|deferiu|indeferiu|concedeu|denegou|julgou)\b"),
    ("orphan_deadline", r"^\s*prazo\s+(?:para\s+[^:]{1,80}:\s*)?\d+\s*(?:\([^)]*\))?\s*dias?\.?\s*$"),
    ("external_case_citation", r"\bPROCESSO\s*:\s*\S+.*?\b(?:RELATOR|DESEMBARGADOR|TURMA|TRIBUNAL)\b.*?\bJULGAMENTO\s*:\s*\d{1,2}/\d{1,2}/\d{2,4}"),
)
MAIN_ORDER = r"\b(?:determino|defiro|indefiro|condeno|fixo|homologo|intime-se|proceda|promova|adote|observe|considere)\b"
#: By their places, patterns that can match only where the lower-cased text has one of these; cheaper, and it spares texts the scan from every start,
#: or back over a long run of letters.
GUARDS = {3: ("\n",), 4: ("data",), 8: ("determinou", "deferiu", "concedeu", "denegou", "julgou"), 10: ("julgamento",)}
#: In lower-cased texts, the letters that patterns take for an i in whatever case: without a dot, and the dot that is left of a capital one's.
_ODD = ("\u0131", "\u0307")
MIN_LENGTH = 12
#: What a text begins with that is not too short: each of these characters is one of the normalized text.
_ENOUGH = f"(?:[^!-~]*+[!-~]){{{MIN_LENGTH}}}"
#: Where a word ends or begins by ASCII's letters alone, as RE2 has it: an accented letter is none. Python's and Java's patterns take it for one.
_WORD = "(?-iuU:[0-9A-Za-z_])"
_ASCII_EDGE = f"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"


def rejection(text: Column, lower: Column | None = None, ascii_words: bool = False) -> Column:
    """The reason why a unit is rejected, null if it isn't. lower: the lower-cased text, if that is a column. Only short texts are normalized.

    ascii_words: words end where ASCII's letters do, as in the queries' SQL; else an accented letter belongs to its word.
    """

    def built(pattern: str) -> str:
        return java(pattern).replace(r"\b", _ASCII_EDGE) if ascii_words else java(pattern)

    text = F.coalesce(text, F.lit(""))
    low = F.lower(text) if lower is None else lower
    odd = F.contains(low, F.lit(_ODD[0])) | F.contains(low, F.lit(_ODD[1]))
    every, guarded, bare = [], [], []
    for place, (reason, pattern) in enumerate(PATTERNS):
        match = starts(text, built(pattern), FLAGS) if pattern.startswith("^") else F.rlike(text, F.lit(FLAGS + built(pattern)))
        if place in GUARDS:
            has = F.contains(low, F.lit(GUARDS[place][0]))
            for part in GUARDS[place][1:]:
                has = has | F.contains(low, F.lit(part))
            bare.append((match, reason))
            guarded.append((has & match, reason))
            match = (has | odd) & match
        every.append((match, reason))
    fragment = F.contains(text, F.lit(":")) & F.endswith(strip(text), F.lit(":")) & ~F.rlike(text, F.lit(FLAGS + built(MAIN_ORDER)))
    few = (F.length(text) < MIN_LENGTH) & ~lengthens(text)
    short = few | (~starts(text, _ENOUGH) & (F.length(normalize(text)) < MIN_LENGTH))
    rest = first_of([(fragment, "trailing_colon_fragment"), (short, "too_short")])
    # most units begin like none of the anchored patterns, which is seen at their start alone
    some = starts(text, "|".join(built(pattern) for place, (_, pattern) in enumerate(PATTERNS) if place not in GUARDS), FLAGS)
    return first_of([(F.ltrim(text, F.lit(BLANK)) == "", "empty")], F.coalesce(first_of([(some, first_of(every)), (odd, first_of(bare))], first_of(guarded)), rest))
