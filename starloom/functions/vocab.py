"""Fixed vocabularies.

Fixed values: these lookup tables and literals must equal the source
system's conventions for results to match; they are data, stated plainly.
Keys are lower-case (looked up after ``lower(trim(x))``) unless noted.
"""

# Default for missing categorical text.
NOT_INFORMED = "nao_informado"

# Unknown dimension members.
UNKNOWN_CUSTOMER = "CLIENTE_DESCONHECIDO"
UNKNOWN_PRODUCT = "PRODUTO_DESCONHECIDO"

# Placeholder customer code used by the order source.
PLACEHOLDER_CUSTOMER = "C9999"

# Order status.
ORDER_STATUS = {
    "faturado": "faturado",
    "em_separacao": "em_separacao",
    "em separacao": "em_separacao",
    "entregue": "entregue",
    "cancelado": "cancelado",
}

# Delivery status (Portuguese/English unified).
DELIVERY_STATUS = {
    "in_transit": "in_transit",
    "delivered": "delivered",
    "cancelled": "cancelled",
    "atrasado": "delayed",
}

# Ticket event type.
EVENT_TYPE = {
    "delay": "delay",
    "refund": "refund",
    "troca": "exchange",
    "cancel_request": "cancel_request",
    "complaint": "complaint",
}

# Carrier mode (accent folding).
CARRIER_MODE = {
    "rodoviário": "rodoviario",
    "rodoviario": "rodoviario",
    "aéreo": "aereo",
    "aereo": "aereo",
}

# Channel type (title case).
CHANNEL_TYPE = {
    "direto": "Direto",
    "indireto": "Indireto",
    "digital": "Digital",
}

# Customer size (title case, accent).
CUSTOMER_SIZE = {
    "grande": "Grande",
    "média": "Média",
    "media": "Média",
    "pequena": "Pequena",
}

# State spellings -> two-letter code.
STATE_TO_UF = {
    "mg": "MG", "minas gerais": "MG",
    "pr": "PR", "parana": "PR", "paraná": "PR",
    "rj": "RJ", "rio de janeiro": "RJ",
    "sc": "SC", "santa catarina": "SC", "sta catarina": "SC", "s. catarina": "SC",
    "sp": "SP", "sao paulo": "SP", "são paulo": "SP",
    "am": "AM", "amazonas": "AM",
    "ba": "BA", "bahia": "BA",
    "go": "GO", "goias": "GO", "goiás": "GO",
}

# Legacy regional code aliases (keys upper-case).
REGIONAL_CODE_ALIAS = {"SUL": "S"}

# Accepted timestamp layouts, tried in this order.
DATETIME_FORMATS = [
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "yyyy-MM-dd",
    "dd/MM/yyyy",
    "yyyy/MM/dd",
]

# Textual sentinels meaning "no number".
NUMERIC_SENTINELS = ["n/a", "unknown", "null", ""]

# Plain decimal shape accepted after comma -> dot.
NUMERIC_PATTERN = r"^-?\d+(\.\d+)?$"

# E-mail shape user@domain.tld.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
