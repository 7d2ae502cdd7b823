"""Ordered rules over a decision and its notice: the first that holds labels the decision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from juriflow.functions.text import WS, first_of, normalize, unfolded

# Id, label, evidence, and what must be contained: N in the normalized decision, R in the raw one,
# E in the normalized notice; H: a heading line of the raw decision.
RULES = (
    ("J01", "certidão migração", "processo migrado", (("N", "o presente processo foi migrado para este sistema eletronico"),)),
    ("J02", "sobrestamento", "sobrestamento", (("N", "finalidade: intimar as partes acerca do sobrestamento do processo"),)),
    ("J03", "falar prescrição", "prescrição intercorrente", (("N", "manifestarem-se sobre a ocorrencia de prescricao intercorrente"),)),
    ("J04", "falar EPE", "manifestar sobre EPE", (("N", "intime-se a credora para se manifestar sobre a epe"),)),
    ("J05", "sentença prescrição/decadência", "extinção art. 487", (("N", "extingo a presente execucao"), ("N", "art. 487"))),
    ("J06", "ajuizada em duplicidade", "duplicidade", (("N", "ajuizada em duplicidade"),)),
    ("J07", "transformação valores", "pagamento definitivo", (("N", "determino a transformacao em pagamento definitivo"),)),
    ("J08", "sentença_proc_EPE", "acolho EPE", (("N", "acolho a excecao de pre-executividade"),)),
    ("J09", "Sentença Resolução CNJ 689/2026", "689/2026 + expediente sentença", (("R", "689/2026"), ("E", "sentenca"))),
    ("J10", "Sentença1 Resolução CNJ 689/2026", "689/2026 + cabeçalho sentença", (("R", "689/2026"), ("H", "SENTENÇA"))),
    ("J11", "Resolução CNJ 689/2026", "689/2026", (("R", "689/2026"),)),
    ("J12", "citação", "expediente citação", (("E", "citacao"),)),
    ("J13", "sentença", "expediente sentença", (("E", "sentenca"),)),
    ("J14", "requisitório", "expediente requisitório", (("E", "intimacao do requisitorio"),)),
    ("J15", "contrarrazões", "expediente contrarrazões", (("E", "intimacao para contrarrazoes"),)),
    ("J16", "contrarrazões1", "texto contrarrazões", (("N", "intimo a(s) parte(s) apelada(s) para apresentar(em) contrarrazoes"),)),
    ("J17", "falar_docs", "novos documentos", (("N", "manifeste-se acerca do(s) novo(s) documento(s) juntado(s) aos autos"),)),
    ("J18", "sentença1", "cabeçalho sentença", (("H", "SENTENÇA"),)),
    ("J19", "ato ordinatório", "cabeçalho ato ordinatório", (("H", "ATO ORDINATÓRIO"),)),
)


#: What rules ask of normalized decisions.
NORMAL = tuple(dict.fromkeys(part for _, _, _, parts in RULES for kind, part in parts if kind == "N"))


def sought(decision: Column) -> Column:
    """Where text_bits looks for what a normalized text contains: the normalized text, if it has odd characters; else nothing where none of it is there,
    and null where some is, which means the text as it is."""
    raw = F.coalesce(decision, F.lit(""))
    odd, _, hints = unfolded(NORMAL)
    firsts = dict.fromkeys(next(hint for part, hint in zip(NORMAL, hints) if ("N", part) in parts) for _, _, _, parts in RULES if any(kind == "N" for kind, _ in parts))
    begins = "".join(dict.fromkeys(hint[1 : hint.index("]")] for hint in firsts))
    some = F.rlike(raw, F.lit(f"(?=[{begins}])(?:{'|'.join(firsts)})"))
    return first_of([(F.rlike(raw, F.lit(r"[^\x00-\xff]")) & F.rlike(raw, F.lit(odd)), normalize(raw)), (some, F.lit(None).cast("string"))], F.lit(""))


def text_bits(decision: Column, sought_: Column) -> Column:
    """A long with a bit for each rule: whether all that it asks of the text holds. sought_: sought(decision), as a column."""
    raw = F.coalesce(decision, F.lit(""))
    _, patterns, hints = unfolded(NORMAL)

    def contained(part: str) -> Column:
        at = NORMAL.index(part)
        return F.coalesce(F.contains(sought_, F.lit(part)), F.rlike(raw, F.lit(hints[at])) & F.rlike(raw, F.lit(patterns[at])))

    bits = F.lit(0).cast("long")
    for place, (_, _, _, parts) in enumerate(RULES):
        holds = F.lit(True)
        for kind, part in parts:
            if kind != "E":
                holds = holds & (contained(part) if kind == "N" else F.contains(raw, F.lit(part)) & (F.lit(True) if kind == "R" else F.rlike(raw, F.lit(rf"{part}{WS}*\n"))))
        bits = bits + F.when(holds, 1 << place).otherwise(0)
    return bits


def by_bits(bits: Column, normalized_notice: Column) -> Column:
    """struct(rule_id, label, evidence) of the first rule whose bit is set and whose notice fits, null if there is none."""
    cases = []
    for place, (rule, label, evidence, parts) in enumerate(RULES):
        holds = bits.bitwiseAND(F.lit(1 << place)) != 0
        for kind, part in parts:
            if kind == "E":
                holds = holds & F.contains(normalized_notice, F.lit(part))
        cases.append((holds, F.struct(F.lit(rule).alias("rule_id"), F.lit(label).alias("label"), F.lit(evidence).alias("evidence"))))
    return first_of(cases)


def classify(decision: Column, notice: Column, normalized: Column | None = None, normalized_notice: Column | None = None) -> Column:
    """struct(rule_id, label, evidence) of the first rule that holds, null if none does."""
    raw = F.coalesce(decision, F.lit(""))
    where = {"N": normalize(raw) if normalized is None else normalized, "R": raw, "E": normalize(notice) if normalized_notice is None else normalized_notice}
    cases = []
    for rule, label, evidence, parts in RULES:
        holds = F.lit(True)
        for kind, part in parts:
            holds = holds & (F.rlike(raw, F.lit(rf"{part}{WS}*\n")) if kind == "H" else F.contains(where[kind], F.lit(part)))
        cases.append((holds, F.struct(F.lit(rule).alias("rule_id"), F.lit(label).alias("label"), F.lit(evidence).alias("evidence"))))
    return first_of(cases)
