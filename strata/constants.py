"""Fixed values the results depend on.

These must equal the reference pipeline's values for identical outputs; they are
listed plainly, in their natural order.
"""

# --- fixed values ---------------------------------------------------------

# Month names used by the calendar dimension (1 = January).
PT_MONTH_NAMES = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)

# Case status values accepted in the cleaned case table.
STATUS_OPEN = "Em andamento"
STATUS_CLOSED = "Baixado"

# Status code table of the event-sourced model: (id, description).
STATUS_CODES = ((1, "Em andamento"), (2, "Baixado"))

# Event-type code table of the event-sourced model: (id, description).
EVENT_TYPE_CODES = (
    (1, "Distribuição"),
    (2, "Conclusão"),
    (3, "Despacho"),
    (4, "Juntada de Petição"),
    (5, "Audiência"),
    (6, "Sentença"),
    (7, "Baixa Definitiva"),
)
EVENT_FILING = 1
EVENT_ORDER = 3
EVENT_SENTENCE = 6
EVENT_CLOSURE = 7
CLOSURE_DESCRIPTION = "Baixa Definitiva"

# Lifecycle offsets of the generated events: order = open + 30 + (id % 200) days,
# sentence = close - 20 days.
ORDER_BASE_DAYS = 30
ORDER_SPREAD_MOD = 200
SENTENCE_LEAD_DAYS = 20

# Case-number template: (id % 10_000_000, district id).
CASE_NUMBER_FORMAT = "%07d-25.2026.8.12.%04d"
CASE_NUMBER_MOD = 10_000_000

# Court label suffix: "<n>ª Vara".
COURT_LABEL_SUFFIX = "ª Vara"
COURTS_PER_DISTRICT = 5

# "Unknown" member added to a dimension so orphan facts stay visible.
UNKNOWN_KEY = 0
UNKNOWN_LABEL = "Não informado"

# Technical ingestion column stamped on every bronze table.
INGESTED_AT = "_ingerido_em"

# Tokens pandas' CSV reader turns into NULL by default (its documented list),
# which the bronze CSV reader replays for text-faithful parity.
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
