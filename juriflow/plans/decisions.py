"""A table of decisions made from `documents` by portable SQL, as input of the queries: metadata by the id, texts by length.

Spark and DuckDB read the SQL alike. Exact copies of a document have the same length and so stay exact copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NN = "chr(10) || chr(10)"
CLASSES = (
    "Mandado de Segurança Cível", "Cumprimento de Sentença", "Procedimento Comum Cível", "Execução Fiscal", "Agravo de Instrumento",
    "Embargos de Declaração", "Embargos à Execução Fiscal", "CumSenFaz", "Ação Civil Pública", "PROCEDIMENTO  COMUM",
)
ORGANS = ("1ª Vara Federal AL", "2ª Vara Federal SE", "Turma Recursal - CE", "13ª Vara Federal PE")
SECTIONS = ("Maceió", "Arapiraca/AL", "Aracaju", "")
NOTICES = ("Intimação (1)", "Sentença", "Citação", "Intimação do Requisitório", "Intimação para Contrarrazões", "Despacho", "Despacho", "Decisão", "Decisão")
TRIGGERS = (
    "O presente processo foi migrado para este sistema eletrônico.",
    "FINALIDADE: intimar as partes acerca do sobrestamento do processo.",
    "Intimem-se para manifestarem-se sobre a ocorrência de prescrição intercorrente.",
    "Intime-se a credora para se manifestar sobre a EPE.",
    "Extingo a presente execução, nos termos do art. 487 do CPC.",
    "A ação foi ajuizada em duplicidade.",
    "Determino a transformação em pagamento definitivo.",
    "Acolho a exceção de pré-executividade.",
    "Conforme a Resolução CNJ 689/2026, arquive-se.",
    "Intimo a(s) parte(s) apelada(s) para apresentar(em) contrarrazões.",
    "Manifeste-se acerca do(s) novo(s) documento(s) juntado(s) aos autos.",
    "Vistas ao Ministério Público.",
)
NOISE = (
    "25111006294315100000147581491", "Assinado eletronicamente por FULANO DE TAL", "20/01/2026 13:10:46", "Arapiraca-AL, data e hora registradas no sistema.",
    "https://pje.example/consulta 251110062943", "Intimações e providências necessárias.", "No mérito, requer a total procedência da ação",
    "Em despacho anterior, o juízo determinou a emenda.", "Prazo para impugnação: 05 (cinco) dias.",
    "PROCESSO: 0800001-11.2020 RELATOR: Desembargador X JULGAMENTO: 01/02/2020", "Nos seguintes termos:", "É o caso.", "A parte sustenta que foi devidamente notificada.",
)
HEADS = ("", "RELATÓRIO", "SENTENÇA" , "DESPACHO", "ATO ORDINATÓRIO", "DECIDO", "Fundamentação:")
ORDERS = (
    "JULGO PROCEDENTE o pedido e condeno a União em honorários.",
    "Diante do exposto, DEFIRO a liminar para suspender a cobrança.",
    "DETERMINO que a contadoria faça os cálculos, devendo considerar:",
    "1. Intime-se a parte autora para manifestar-se no prazo de 15 dias.",
    "Expeça-se requisição de pagamento (RPV).",
    "Homologo o acordo e declaro a prescrição.",
    "Arquivem-se os autos.",
)


def _pick(values: tuple[str, ...], index: str) -> str:
    arms = " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(values[:-1]))
    return f"CASE {index} {arms} ELSE '{values[-1]}' END"


def _digit(base: int, size: int) -> str:
    return f"CAST(floor(n_chars / {base}) AS BIGINT) % {size}"


SQL = f"""
SELECT CAST(doc_id + 2 AS INT) AS source_row,
       'P' || CAST(CAST(floor(doc_id / 3) AS BIGINT) AS VARCHAR(20)) AS processo,
       {_pick(CLASSES, "doc_id % 10")} AS classe, 'TRF5' AS origem,
       {_pick(ORGANS, "doc_id % 4")} AS orgao_julgador, '2026-01-15' AS data, '' AS polo_ativo, '' AS polo_passivo,
       {_pick(NOTICES, "doc_id % 9")} AS expediente,
       CASE WHEN doc_id % 4 = 0 THEN '' ELSE CAST(doc_id % 4 * 5 AS VARCHAR(20)) END AS prazo, 'Tributário' AS assunto,
       {_pick(SECTIONS, "doc_id % 4")} AS secao_subsecao, 'https://pje.example/' || CAST(doc_id AS VARCHAR(20)) AS link, 'N1' AS nucleo,
       CASE WHEN n_chars % 29 = 0 THEN '  ' || chr(10) ELSE
         {_pick(HEADS, _digit(1, 7))} || {NN} || replace(text, chr(10), {NN}) || {NN}
         || CASE WHEN n_chars % 3 = 0 THEN {_pick(TRIGGERS, _digit(3, 12))} || {NN} ELSE '' END
         || {_pick(NOISE, _digit(5, 13))} || {NN} || 'DISPOSITIVO' || {NN} || {_pick(ORDERS, _digit(7, 7))} || {NN}
         || 'a) juros de mora sobre o valor;' || {NN} || 'b) correção.' || {NN} || {_pick(ORDERS, _digit(11, 7))} END AS decisao
FROM documents
"""


def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return spark.sql(SQL.replace("VARCHAR(20)", "STRING").replace("FROM documents", "FROM {documents}"), documents=docs)
