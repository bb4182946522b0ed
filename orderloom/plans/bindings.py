"""The domain tables, derived from the given star-schema tables.

Every column is computed by Spark from ``lineitem orders customer nation events``, so
the work of each query grows with those tables.
"""

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.picking import first_rows
from orderloom.operators.shaping import rule_table
from orderloom.operators.state import as_stored
from orderloom.rules import ACTIVE_STATUS, GREETING_CODE
from orderloom.sources.captures import detail_pages, listing_rows

# Configuration of the derived world: small rule tables.
CENTERS = [("CD-0", "A", "CD-0", "erp-1"), ("CD-1", "A", "ERP1", "erp-1"),
           ("CD-2", "B", "CD-2", "erp-2"), ("CD-3", "B", "ERP3", "erp-2")]
REJECT_CENTERS = [("CD-0",), ("CD-1",), ("CD-2",)]
BRANCH_SOURCES = [("north", "erp-1"), ("south", "erp-2"), ("outlet", "erp-1"), ("west", None)]
CREDIT_SOURCES = [("A", "erp-1"), ("B", "erp-2"), ("C", None)]
BRANCH_STATES = [("RJ-1", "RJ", "erp-1"), ("SP-1", "SP", "erp-2"), ("MG-1", "MG", "erp-1")]
CONTACTS = [("A", "chat-a", "Ana"), ("B", "chat-b", ""), ("C", None, "Caio")]
REGIONAL = ["ANGRA DOS REIS", "VOLTA REDONDA", "PARATY"]
INTERIOR = ["PARATY", "PETRÓPOLIS", "ANGRA DOS REIS"]
AS_OF = "2024-01-10 09:30:00"

CITIES = ["ANGRA DOS REIS, RJ", "Volta Redonda, RJ", "RIO DE JANEIRO, RJ", "Petrópolis, RJ",
          "São Paulo, SP", " Paraty, RJ ", "Niterói, RJ", "Belo Horizonte, MG"]
PAYMENTS = {"1": "Dinheiro", "2": "Pix na entrega", "3": "Cartão de Débito na Entrega",
            "4": "Boleto", "5": "Cartão de Crédito na Entrega (Somente em 1x)"}


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def k14(c: Column) -> Column:
    return F.lpad(text(c), 14, "0")


def dotted(c: Column) -> Column:
    """A 14-digit number as 00.000.000/0000-00."""
    s = k14(c)
    for at, mark in ((13, "-"), (9, "/"), (6, "."), (3, ".")):
        s = F.overlay(s, F.lit(mark), at, 0)
    return s


def us_money(amount: Column) -> Column:
    """Cents as ``$1,234.56``."""
    units = F.floor(amount / 100)
    whole = (F.when(units < 1000, text(units))
             .when(units < 1000000, F.concat(text(F.floor(units / 1000)), F.lit(","),
                                             F.lpad(text(units % 1000), 3, "0")))
             .otherwise(F.format_number(units, 0)))
    return F.concat(F.lit("$"), whole, F.lit("."), F.lpad(text(amount % 100), 2, "0"))


def plain_money(amount: Column) -> Column:
    """Cents as ``1234.56``, negative amounts included."""
    return text((amount / 100).cast("decimal(18,2)"))


def pick(index: Column, values: list[str]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


#: Fields of an item's place among all items.
ORD = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate", "l_extendedprice"]


def contact_texts() -> list[Column]:
    """Contact and city columns of a customer."""
    key = F.col("c_custkey")
    number = F.lpad(text(key), 8, "0")
    return [
        F.concat(F.lit("Resp "), text(key % 10)).alias("responsible"),
        F.when(key % 5 == 0, "ISENTO").otherwise(F.concat(F.lit("IE"), text(key))).alias("state_reg"),
        F.when(key % 21 != 0, F.col("c_name")).alias("trade_name"),
        F.concat(F.lit("Rua "), text(key)).alias("street"),
        pick(F.col("c_nationkey") % 8, CITIES).alias("city_uf"), number.alias("zip"),
        F.concat(F.lit("+55(21)9"), F.substring(number, 1, 4), F.lit("-"),
                 F.substring(number, 5, 4), F.lit(".0")).alias("phone_1"),
        F.when(key % 4 != 0, F.concat(F.lit("+5521 "), number)).alias("phone_2"),
        F.when(key % 6 != 0, F.concat(F.lit("c"), text(key), F.lit("@example.com")))
        .alias("email_1")]


def header_texts() -> list[Column]:
    """Header columns of an order."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    day = text(F.to_date("o_orderdate"))
    return [
        F.when(key % 2 == 0, "north").otherwise("south").alias("branch"),
        text(key).alias("order_no"), day.alias("order_date"),
        F.concat(F.lit("CD-"), text("n_regionkey")).alias("center"),
        F.when(F.col("o_orderstatus") == "P", "A ser preparado")
        .when(F.col("o_orderstatus") == "F", "Entregue").otherwise("Cancelado").alias("status"),
        F.try_element_at(F.create_map(*[F.lit(x) for kv in PAYMENTS.items() for x in kv]),
                         F.substring("o_orderpriority", 1, 1)).alias("payment"),
        F.when(key % 4 == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(key % 4 == 1, F.lit("")).when(key % 4 == 2, F.concat(day, F.lit(" 10:00")))
        .otherwise(day).alias("delivery_date"),
        us_money(cents("o_totalprice")).alias("order_total"),
        F.when(cust % 7 == 0, F.concat(F.lit("CPF: "), F.lpad(text(cust), 11, "0")))
        .when(cust % 13 == 0, F.lit("")).otherwise(F.concat(F.lit("CNPJ: "), k14(cust)))
        .alias("document"),
        *contact_texts(), F.lit("").alias("coordinates"),
        F.concat(F.lit("neg-"), text(key)).alias("business_id"),
        F.when(cust % 3 == 0, dotted(cust)).when(cust % 17 == 0, F.concat(F.lit("acct-"), text(cust)))
        .otherwise(k14(cust)).alias("account_id"),
        F.when(key % 4 != 0, text(cust)).alias("codcli"), F.lit("").alias("email_2"),
        (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=key % 86400))
        .alias("collected_at")]


def item_texts() -> list[Column]:
    """Item columns of a line."""
    quantity = (F.when(F.col("l_partkey") % 50 == 0, "0").when(F.col("l_partkey") % 51 == 0, "")
                .otherwise(text(F.col("l_quantity").cast("bigint"))))
    return [F.struct(*ORD).alias("ord"), text("l_partkey").alias("sku"),
            us_money(cents("l_extendedprice")).alias("price"), quantity.alias("quantity"),
            quantity.alias("quantity_prepared"),
            F.concat(F.lit("Produto "), text("l_partkey")).alias("product_name")]


class Tables:
    """Lazy domain tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._raw[name]

    def rules(self, rows: list[tuple], schema: str) -> DataFrame:
        return rule_table(self.spark, rows, schema)

    @cached_property
    def as_of(self) -> Column:
        return F.lit(AS_OF).cast("timestamp")

    @cached_property
    def order_values(self) -> DataFrame:
        """The values that an order's header texts are made of. Joins carry these; the texts, many
        times wider, are made above the joins."""
        return (self.raw("orders")
                .join(self.raw("customer").select("c_custkey", "c_name", "c_nationkey"),
                      F.col("o_custkey") == F.col("c_custkey"))
                .join(self.raw("nation").select("n_nationkey", "n_regionkey"),
                      F.col("c_nationkey") == F.col("n_nationkey")))

    @cached_property
    def headers(self) -> DataFrame:
        """One header per order."""
        return self.order_values.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                        *header_texts())

    @cached_property
    def item_values(self) -> DataFrame:
        """The values of each line with those of its order."""
        lines = self.raw("lineitem").select(*ORD, "l_quantity")
        return self.order_values.join(lines, F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def order_items(self) -> DataFrame:
        return self.item_values.select("o_orderkey", "o_orderstatus", *header_texts(), *item_texts())
    @cached_property
    def items(self) -> DataFrame:
        """The stored item table, without the helper columns."""
        return self.order_items.drop("o_orderkey", "o_orderstatus")

    @cached_property
    def erp_clients(self) -> DataFrame:
        """Customers per ERP source, some documents shared by two of them."""
        key = F.col("c_custkey")
        doc = F.concat(F.substring(k14(key), 1, 12), F.lit("-"), F.substring(k14(key), 13, 2))
        base = self.raw("customer").select(
            key, F.col("c_name").alias("cliente"), F.when(key % 19 != 0, doc).alias("cgcent"),
            F.when(key % 20 == 0, "S").otherwise("N").alias("bloqueio"),
            F.when(key % 23 != 0, plain_money(cents("c_acctbal") * 60)).alias("limcred"),
            F.explode(F.when(key % 29 == 0, F.array(key, key + 1000000))
                      .otherwise(F.array(key))).alias("code"),
            F.when(key % 3 != 2, F.array(F.lit("erp-1"), F.lit("erp-2")))
            .otherwise(F.array(F.lit("erp-1"))).alias("sources"))
        return base.select(text("code").alias("codcli"), "cliente", "cgcent", "bloqueio", "limcred",
                           F.explode("sources").alias("source"))

    @cached_property
    def erp_receivables(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.raw("orders").select(
            F.when(key % 2 == 0, "erp-1").otherwise("erp-2").alias("source"),
            text("o_custkey").alias("codcli"), plain_money(cents("o_totalprice")).alias("valor"),
            F.when(F.col("o_orderstatus") == "P", "0").when(F.col("o_orderstatus") == "F", "1")
            .alias("vpago"))

    @cached_property
    def erp_orders(self) -> DataFrame:
        """ERP orders, of which every third holds one of our order numbers."""
        key = F.col("o_orderkey")
        return self.raw("orders").select(F.when(key % 3 == 0, text(key)).alias("numpedcli"))

    @cached_property
    def registry(self) -> DataFrame:
        """Known companies: three quarters of the customers."""
        key = F.col("c_custkey")
        status = F.when(key % 11 == 0, "Baixada").when(key % 11 != 1, ACTIVE_STATUS)
        ie_status = (F.when(key % 6 == 0, "Não habilitada").when(key % 6 == 1, "Não encontrada")
                     .when(key % 6 != 2, "Sem restrição"))
        return self.raw("customer").where(key % 4 != 3).select(
            k14(key).alias("cnpj"), F.col("c_name").alias("nome"),
            F.when(key % 9 != 0, F.concat(F.lit("Loja "), text(key))).alias("nome_fantasia"),
            status.alias("status"), F.concat(F.lit("Cidade "), text(key % 50)).alias("cidade"),
            pick(key % 4, ["RJ", "SP", "MG", "ES"]).alias("uf"), ie_status.alias("ie_status"),
            F.lit("2024-01-01 00:00:00").cast("timestamp").alias("consultado_em"))

    @cached_property
    def company_json(self) -> DataFrame:
        """A registry answer per customer, as JSON text: nulls, absences, empty arrays."""
        key = F.col("c_custkey")
        n = text(key)

        def q(c: Column) -> Column:
            return F.concat(F.lit('"'), c, F.lit('"'))

        def phone(i: int) -> Column:
            return F.concat(F.lit('{"area":"2%d","number":"' % i), n, F.lit('"}'))

        alias = (F.when(key % 3 == 0, '"alias":null,').when(key % 3 == 1, "")
                 .otherwise(F.concat(F.lit('"alias":"Loja '), n, F.lit('",'))))
        phones = (F.when(key % 3 == 0, "").when(key % 3 == 1, phone(1))
                  .otherwise(F.concat(phone(1), F.lit(","), phone(2))))
        regs = F.when(key % 5 == 0, "").otherwise(F.concat(
            F.lit('{"state":"RJ","number":"'), n,
            F.lit('","status":{"text":"Sem restrição"},"statusDate":null}')))
        doc = F.concat(
            F.lit('{"taxId":'), q(k14(key)), F.lit(","), alias,
            F.lit('"founded":"2001-02-03","company":{"name":"Empresa '), n, F.lit('","equity":'),
            text(key * 1000), F.lit('.50,"size":{"text":"ME"},"simples":{"optant":'),
            F.when(key % 2 == 0, "true").otherwise("false"),
            F.lit('},"simei":{"optant":null}},"status":{"text":"Ativa"},"address":{"street":"Rua '),
            n, F.lit('","details":null,"city":"Niterói","state":"RJ"},"phones":['), phones,
            F.lit('],"emails":[{"address":"e'), n, F.lit('@example.com"}],"mainActivity":'),
            F.when(key % 4 == 0, "null").otherwise('{"text":"Varejo"}'),
            F.lit(',"sideActivities":[],"registrations":['), regs, F.lit("]}"))
        return self.raw("customer").select(k14(key).alias("asked"), doc.alias("doc"))

    @cached_property
    def invoice_text(self) -> DataFrame:
        """A raw invoice text per order."""
        key = F.col("o_orderkey")
        run = F.lpad(text(key), 44, "7")
        blocks = F.concat_ws(" ", *[F.substring(run, 1 + 4 * i, 4) for i in range(11)])
        return self.raw("orders").select(text(key).alias("order_no"), F.concat(
            F.lit("DANFE CNPJ "), dotted(F.col("o_custkey")), F.lit(" CHAVE "), blocks,
            F.lit(" VALOR TOTAL DA NOTA R$ "), text(F.floor("o_totalprice")), F.lit(",00 | FIM"))
            .alias("body"))

    @cached_property
    def credit_events(self) -> DataFrame:
        """Credit notices: who was notified when."""
        return self.raw("events").select(
            "event_id", F.concat(F.lit("B"), text(F.col("user_id") % 5)).alias("branch"),
            text("user_id").alias("codcli"), F.col("ts").cast("timestamp").alias("ts"), "event_type")

    @cached_property
    def ledger(self) -> DataFrame:
        """A ledger written from every second event, and greetings from the errors."""
        rows = self.credit_events.withColumn("day", F.to_date("ts"))
        notices = rows.where("event_id % 2 = 0").groupBy("branch", "codcli", "day").agg(
            F.min("ts").alias("at"))
        greetings = rows.where("event_type = 'error' AND event_id % 2 = 0").groupBy(
            "branch", "day").agg(F.min("ts").alias("at"))
        clock = F.date_format("at", "HH:mm:ss").alias("sent_time")
        return (notices.select("branch", "codcli", F.col("day").alias("sent_day"), clock,
                               F.lit(None).cast("date").alias("greeted_day"))
                .unionByName(greetings.select(
                    "branch", F.lit(GREETING_CODE).alias("codcli"), F.col("day").alias("sent_day"),
                    clock, F.col("day").alias("greeted_day"))))

    @cached_property
    def credit_ledger(self) -> DataFrame:
        """Ledger of the credit branches on the reporting day: every fifth customer was
        notified, and branch B was greeted."""
        day = F.to_date(self.as_of)
        told = self.raw("customer").where("c_custkey % 5 = 0").select(
            F.explode(F.array(F.lit("A"), F.lit("B"))).alias("branch"),
            text("c_custkey").alias("codcli"), day.alias("sent_day"),
            F.lit("08:00:00").alias("sent_time"), F.lit(None).cast("date").alias("greeted_day"))
        hello = self.raw("region").where("r_regionkey = 0").select(
            F.lit("B").alias("branch"), F.lit(GREETING_CODE).alias("codcli"),
            day.alias("sent_day"), F.lit("08:00:00").alias("sent_time"), day.alias("greeted_day"))
        return told.unionByName(hello)

    @cached_property
    def queue(self) -> DataFrame:
        """Orders sent before: every seventh."""
        return self.raw("orders").where("o_orderkey % 7 = 0").select(
            text("o_orderkey").alias("order_no"), F.col("o_orderdate").cast("timestamp").alias("sent_at"))

    @cached_property
    def stored_items(self) -> DataFrame:
        """Items stored before the capture, one per (order, sku): picked by the keys that these texts
        are made of, where the join has the lines of an order already."""
        old = self.item_values.where("o_orderkey % 3 <> 0")
        first = first_rows(old, ["o_orderkey", "l_partkey"], ORD)
        return as_stored(first.select(*header_texts(), *item_texts()))

    @cached_property
    def listing_capture(self) -> DataFrame:
        """Captured listing rows of the active orders; some orders twice, some rows short."""
        key = F.col("o_orderkey")
        cells = F.array(text(key), text(F.to_date("o_orderdate")), F.lit(" x "), F.lit("Resp"),
                        us_money(cents("o_totalprice")))
        seen = self.raw("orders").where("o_orderstatus = 'P'").select(
            F.when(key % 2 == 0, "north").otherwise("south").alias("branch"),
            F.explode(F.when(key % 10 == 0, F.array(key, key + 1000000)).otherwise(F.array(key)))
            .alias("pos"),
            F.when(key % 97 == 0, F.slice(cells, 1, 3)).otherwise(cells).alias("cells"))
        return seen

    @cached_property
    def listing(self) -> DataFrame:
        return listing_rows(self.listing_capture)

    @cached_property
    def captured(self) -> DataFrame:
        return self.rules([("north", True), ("south", True)], "branch string, complete boolean")

    @cached_property
    def whole_capture(self) -> DataFrame:
        """A captured detail page per active order, its item table as one array."""
        active = self.order_items.where("o_orderstatus = 'P'")
        head = ["branch", "o_orderkey", "status", "center", "payment", "document", "trade_name",
                "street", "city_uf", "zip", "phone_1", "phone_2", "email_1", "account_id"]
        body = ["product_name", "sku", "price", "quantity", "quantity_prepared"]
        # A captured page is one row by nature, so its item table is gathered here.
        entry = F.struct("ord", F.struct(*body).alias("row"))
        # By the order's key, of which the number is the text: the join has its lines already.
        pages = active.groupBy(F.col("o_orderkey").alias("_order")).agg(
            F.min_by(F.struct("order_no", *head), "ord").alias("head"),
            F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["row"]).alias("rows"))
        pages = pages.select("head.*", "rows")
        key = F.col("o_orderkey")

        def block(label: str, *texts: Column) -> list[Column]:
            return [F.lit(label), F.array_compact(F.array(F.lit(label), *texts))]

        labels = F.create_map(
            *block("Tax ID", F.concat(F.lit(" "), "document", F.lit(" ")),
                   F.when(key % 3 == 0, F.lit("INSCRICAO_ESTADUAL: 123"))),
            *block("Nome comercial", F.col("trade_name")),
            *block("Endereço de entrega", F.col("street"), F.when(key % 4 != 0, F.col("city_uf")),
                   F.when(key % 4 != 0, F.col("zip"))),
            *block("telefone", F.col("phone_1"), F.col("phone_2")),
            *block("E-mail", F.col("email_1")),
            *block("pagamento", F.when(key % 5 == 0, F.lit("")).otherwise(F.col("payment"))),
            *block("ID do negócio", F.concat(F.lit("neg-"), "order_no")),
            *block("ID da conta do cliente", F.col("account_id")))
        status = F.when(key % 9 != 0, F.concat(F.lit(" "), "status"))
        return pages.select("branch", "order_no", labels.alias("labels"),
                            status.alias("status"), "center", F.col("rows").alias("items"))

    @cached_property
    def detail_capture(self) -> DataFrame:
        """The same pages where the price of one product could not be read."""
        return self.whole_capture.withColumn("items", F.transform("items", lambda r: r.withField(
            "price", F.when(r["sku"] != "7", r["price"]))))

    @cached_property
    def whole_details(self) -> DataFrame:
        return detail_pages(self.whole_capture)

    @cached_property
    def details(self) -> DataFrame:
        return detail_pages(self.detail_capture)
