"""Texts, codes and lists that decide results.

Everything that belongs to one company (branches, centres, ERP sources,
contacts) is *not* here; it is passed to the operators as a small rule table.
"""

# Payment method -> ERP code (exact match, other texts unchanged).
PAYMENT_CODES = {
    "Cartão de Crédito na Entrega (Somente em 1x)": "CARC",
    "Cartão de Débito na Entrega": "CARD",
    "Dinheiro": "D",
    "Pix na entrega": "QR",
}

# Statuses that mean "to be prepared".
PENDING_FOR_REJECTION = ["A ser preparado"]
PENDING_FOR_PREPARATION = ["A ser preparado", "To be prepared"]

# A company is in order when it has this status and one of these
# state-registration statuses.
ACTIVE_STATUS = "Ativa"
REGISTRATION_OK = ["Sem restrição", "Não encontrada"]

# Defaults of the registry record and of captured pages.
NOT_AVAILABLE = "Não disponível"
NO_DATA = "N/D"
NO_ACTIVITY = "Nenhuma"
NOT_FOUND_F = "Não encontrada"
NOT_FOUND_M = "Não encontrado"
NOT_CAPTURED = "Não capturado"
EXEMPT = "ISENTO"
STATE_REG_PREFIX = "INSCRICAO_ESTADUAL: "
UNKNOWN_BRANCH = "Desconhecida"
NEVER = "nunca"
DASH = "—"

# Fixed value: customer code of a greeting row in the dispatch ledger.
GREETING_CODE = "__saudacao__"

# Day greetings and message texts.
MORNING, AFTERNOON, NIGHT = "Bom dia", "Boa tarde", "Boa noite"
ROUTE_OPENING = "Pedidos sendo enviados!"
CREDIT_OPENING = "Seguem os clientes para solicitação de limite:"
CREDIT_CLOSING = "Poderia liberar o limite para esses clientes, por favor? Obrigado!"

# Cities of the regional route and cities excluded from the
# general route (already upper-case, duplicates left out).
REGIONAL_CITIES = [
    "BARRA MANSA", "VOLTA REDONDA", "RIO CLARO", "MANGARATIBA", "ANGRA DOS REIS",
    "PINHEIRAL", "PARATY", "LÍDICE",
]
# The city list of the early "is there anything to send" test,
# which differs from the one above in its last entry.
REGIONAL_PROBE_CITIES = [
    "PARATY", "BARRA MANSA", "VOLTA REDONDA", "RIO CLARO", "MANGARATIBA",
    "ANGRA DOS REIS", "PINHEIRAL", "ARROZAL",
]
INTERIOR_CITIES = [
    "PARATY", "PATY DO ALFERES", "VALENCA", "ITATIAIA", "RESENDE", "PORTO REAL",
    "QUATIS", "BARRA MANSA", "VOLTA REDONDA", "ARROZAL", "PINHEIRAL", "PIRAI",
    "BARRA DO PIRAI", "MENDES", "VASSOURA", "RIO CLARO", "CACHOEIRAS DE MACACU",
    "MIGUEL PEREIRA", "TANGUA", "BARRA DO PIRAÍ", "SAO JOSE DO VALE DO RIO PRETO",
    "AREAL", "PARAÍBA DO SUL", "ANGRA DOS REIS", "PETRÓPOLIS", "TERESÓPOLIS",
    "LIDICE", "LÍDICE",
]
GENERAL_STATE = "RJ"
GENERAL_DOCUMENT = "CPF"

# Patterns of the invoice text extraction.
TAX_ID_PATTERN = r"(\d{2}\.?\d{3}\.?\d{3}/\d{4}-?\d{2})"
TOTAL_PATTERN = r"(?i)(?:TOTAL|NOTA)\s*(?:R\$)?\s*[:\.]?\s*([\d\.,]+)"
KEY_RUN_PATTERN = r"([\d\s]{40,65})"
KEY_DIGITS = 44

# Fixed value: orders per dashboard page.
PAGE_SIZE = 20
