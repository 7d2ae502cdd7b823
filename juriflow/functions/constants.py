"""Fixed values shared by the operators: categories and states."""

CATEGORIES = (
    "resultado_julgamento",
    "ordem_determinacao",
    "intimacao_manifestacao",
    "tutela",
    "obrigacao",
    "prazo_cumprimento",
    "restituicao_pagamento",
    "honorarios_custas",
    "recurso_proximo_passo",
    "prescricao_decadencia",
    "reconhecimento_concordancia",
    "outro_acionavel",
)
SLOT_STATES = ("PENDENTE", "APROVADO", "AJUSTADO", "REJEITADO")
DOCUMENT_STATES = ("PENDENTE_REVISAO", "VALIDADO_COMPLETO")
COLUMNS = (
    "processo", "classe", "origem", "orgao_julgador", "data", "polo_ativo", "polo_passivo",
    "expediente", "prazo", "assunto", "secao_subsecao", "link", "decisao", "nucleo",
)
REQUIRED = ("processo", "classe", "orgao_julgador", "expediente", "decisao")
