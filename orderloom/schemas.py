"""Canonical schemas and the display-label dialects that map onto them."""

from pyspark.sql import types as T

# Display label -> canonical column, order items.
ORDER_LABELS = {
    "Numero Pedido": "order_no",
    "Data Pedido": "order_date",
    "Centro de Distribuição": "center",
    "Status": "status",
    "Forma de Pagamento": "payment",
    "Data Entrega": "delivery_date",
    "Responsavel": "responsible",
    "Total Pedido": "order_total",
    "Documento": "document",
    "IE": "state_reg",
    "Nome Comercial": "trade_name",
    "Endereço de Entrega": "street",
    "Cidade/UF": "city_uf",
    "CEP": "zip",
    "Coordenadas": "coordinates",
    "ID do negócio": "business_id",
    "ID da conta do cliente": "account_id",
    "SKU": "sku",
    "Preço": "price",
    "Quantidade Pedida": "quantity",
    "Nome do Produto": "product_name",
    "Quantidade Preparar": "quantity_prepared",
    "Telefone 1": "phone_1",
    "Telefone 2": "phone_2",
    "Email 1": "email_1",
    "Email 2": "email_2",
}

# Display label -> canonical column, company registry.
REGISTRY_LABELS = {
    "CNPJ": "cnpj",
    "Nome": "nome",
    "Nome Fantasia": "nome_fantasia",
    "Capital Social": "capital_social",
    "Natureza Jurídica": "natureza_juridica",
    "Tamanho": "tamanho",
    "Data de Fundação": "data_fundacao",
    "Status": "status",
    "Data de Status": "data_status",
    "Razão de Status": "razao_status",
    "Rua": "rua",
    "Número": "numero",
    "Complemento": "complemento",
    "Bairro": "bairro",
    "Cidade": "cidade",
    "UF": "uf",
    "CEP": "cep",
    "Telefone": "telefone",
    "Email": "email",
    "Atividade Principal": "atividade_principal",
    "Atividades Secundárias": "atividades_secundarias",
    "Simples Nacional Optante": "simples_optante",
    "SIMEI Optante": "simei_optante",
    "Inscrição Estadual Estado": "ie_estado",
    "Inscrição Estadual Número": "ie_numero",
    "Inscrição Estadual Status": "ie_status",
    "Inscrição Estadual Tipo": "ie_tipo",
    "Inscrição Estadual Data de Status": "ie_data_status",
}

# Order header fields, in dashboard order.
HEADER_FIELDS = [
    "order_date", "delivery_date", "status", "center", "order_total", "document",
    "state_reg", "trade_name", "street", "city_uf", "zip", "payment", "responsible",
    "phone_1", "phone_2", "email_1", "email_2", "business_id", "account_id", "codcli",
    "branch",
]
ITEM_FIELDS = ["sku", "product_name", "price", "quantity", "quantity_prepared"]

# Columns written by an item insert; nulls are stored as blank text.
STORED_FIELDS = ["branch", *ORDER_LABELS.values()]


def text_schema(names: list[str]) -> T.StructType:
    """All-text schema, so that reading files never infers types."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


REGISTRY_SCHEMA = T.StructType(
    [*text_schema(list(REGISTRY_LABELS.values())).fields,
     T.StructField("consultado_em", T.TimestampType())])

LEDGER_SCHEMA = T.StructType([
    T.StructField("branch", T.StringType()),
    T.StructField("codcli", T.StringType()),
    T.StructField("sent_day", T.DateType()),
    T.StructField("sent_time", T.StringType()),
    T.StructField("greeted_day", T.DateType()),
])

# JSON ledger document: branch -> greeting day, time, day -> customers.
LEDGER_JSON = ("map<string,struct<ultima_saudacao:string,horario:string,"
               "clientes:map<string,array<string>>>>")
