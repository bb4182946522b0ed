"""Orders as nested JSON documents, written while rows stream by.

A document is written line by line: the header with the first item, one line for each further item,
brackets closed behind the last. The rows come from one window by order, which looks at the row before
and after only, so no order is held in memory, whatever its size; a document is one sequence of lines in
one file and so written by one task.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Keys of the order documents, in their order, and the columns they show.
HEADER_KEYS = {
    "Numero Pedido": "order_no",
    "Data Pedido": "order_date",
    "Data Entrega": "delivery_date",
    "Status": "status",
    "Centro de Distribuição": "center",
    "Total Pedido": "order_total",
    "Documento": "document",
    "IE": "state_reg",
    "Nome Comercial": "trade_name",
    "Endereço de Entrega": "street",
    "Cidade/UF": "city_uf",
    "CEP": "zip",
    "Forma de Pagamento": "payment",
    "Responsavel": "responsible",
    "Telefone 1": "phone_1",
    "Telefone 2": "phone_2",
    "Email 1": "email_1",
    "Email 2": "email_2",
    "ID do negócio": "business_id",
    "ID da conta do cliente": "account_id",
    "Cod Cliente": "codcli",
    "filial": "branch",
}
ITEM_KEYS = {
    "SKU": "sku",
    "Nome do Produto": "product_name",
    "Preco": "price",
    "Quantidade Pedida": "quantity",
    "Quantidade Preparar": "quantity_prepared",
}
ITEMS_KEY = "itens"

DOCUMENT = "struct<{}, `{}`: array<struct<{}>>>".format(
    ", ".join(f"`{k}`: string" for k in HEADER_KEYS), ITEMS_KEY,
    ", ".join(f"`{k}`: string" for k in ITEM_KEYS))
CLOSED = "]}"


def _json(keys: dict[str, str]) -> Column:
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(k) for k, c in keys.items()]),
                     {"ignoreNullFields": "false"})


def document_lines(items: DataFrame, order: str = "ord") -> DataFrame:
    """(order_no, place, text): the lines of all documents, in order within a partition."""
    by_order = Window.partitionBy("order_no").orderBy(order)
    numbered = items.withColumns({"place": F.row_number().over(by_order),
                                  "_next": F.lead(F.lit(1)).over(by_order)})
    head = F.concat(F.regexp_replace(_json(HEADER_KEYS), r"\}$", ""), F.lit(f',"{ITEMS_KEY}":['))
    text = F.concat(F.when(F.col("place") == 1, head).otherwise(F.lit(",")), _json(ITEM_KEYS),
                    F.when(F.col("_next").isNull(), F.lit(CLOSED)).otherwise(F.lit("")))
    return numbered.select("order_no", "place", text.alias("text"))


def write_documents(items: DataFrame, folder: str, order: str = "ord", compression: str = "none") -> None:
    """One document per order, several per file, one behind the other. A compressed file is read by
    one task, as it was written by one."""
    (document_lines(items, order).select("text").write.mode("overwrite")
     .option("compression", compression).text(folder))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of ``write_documents`` as one column ``order``; each must fit into a row."""
    # No other line ends with these brackets, as texts hold no line break.
    texts = spark.read.option("lineSep", f"{CLOSED}\n").text(folder)
    return texts.select(F.from_json(F.concat("value", F.lit(CLOSED)), DOCUMENT).alias("order"))
