"""SQL twins of the registered queries, written for DuckDB over the given tables.

``BASE`` holds the domain tables as common table expressions; a statement gets those it
names, with everything they need, in front.
"""

import re

ORD = "l_orderkey, l_linenumber, l_suppkey, l_partkey, l_shipdate, l_extendedprice"


def usd(cents: str) -> str:
    return f"'$' || format('{{:,}}', {cents} // 100) || '.' || lpad(({cents} % 100)::varchar, 2, '0')"


def plain(cents: str) -> str:
    """Cents, possibly negative, as plain decimal text."""
    return (f"case when {cents} < 0 then '-' else '' end || (abs({cents}) // 100)::varchar || '.' "
            f"|| lpad((abs({cents}) % 100)::varchar, 2, '0')")


def brl(cents: str) -> str:
    return (f"case when {cents} < 0 then '-' else '' end || 'R$' || chr(160) || "
            f"replace(format('{{:,}}', abs({cents}) // 100), ',', '.') || ',' || "
            f"lpad((abs({cents}) % 100)::varchar, 2, '0')")


def dotted(key: str) -> str:
    k = f"lpad({key}::varchar, 14, '0')"
    return (f"substr({k},1,2)||'.'||substr({k},3,3)||'.'||substr({k},6,3)||'/'||substr({k},9,4)"
            f"||'-'||substr({k},13,2)")


PAY = {"Dinheiro": "D", "Pix na entrega": "QR", "Cartão de Débito na Entrega": "CARD",
       "Cartão de Crédito na Entrega (Somente em 1x)": "CARC"}
PAY_CASE = "case payment " + " ".join(f"when '{k}' then '{v}'" for k, v in PAY.items()) + " else payment end"
HEADER = ("order_date, delivery_date, status, center, order_total, document, state_reg, trade_name, "
          "street, city_uf, zip, payment, responsible, phone_1, phone_2, email_1, email_2, "
          "business_id, account_id, codcli, branch")

BASE = {
    "hdr": f"""
select o_orderkey, o_custkey, o_orderstatus, round(o_totalprice*100)::bigint total_cents,
  case when o_orderkey % 2 = 0 then 'north' else 'south' end branch,
  o_orderkey::varchar order_no, o_orderdate::date::varchar order_date,
  'CD-' || n_regionkey center,
  case o_orderstatus when 'P' then 'A ser preparado' when 'F' then 'Entregue' else 'Cancelado' end status,
  case o_orderpriority[1] when '1' then 'Dinheiro' when '2' then 'Pix na entrega'
    when '3' then 'Cartão de Débito na Entrega' when '4' then 'Boleto'
    when '5' then 'Cartão de Crédito na Entrega (Somente em 1x)' end payment,
  case o_orderkey % 4 when 0 then strftime(o_orderdate, '%d/%m/%Y') when 1 then ''
    when 2 then o_orderdate::date::varchar || ' 10:00' else o_orderdate::date::varchar end delivery_date,
  'Resp ' || (o_custkey % 10) responsible,
  {usd("round(o_totalprice*100)::bigint")} order_total,
  case when o_custkey % 7 = 0 then 'CPF: ' || lpad(o_custkey::varchar, 11, '0')
    when o_custkey % 13 = 0 then '' else 'CNPJ: ' || lpad(o_custkey::varchar, 14, '0') end document,
  case when o_custkey % 7 = 0 then lpad(o_custkey::varchar, 11, '0')
    when o_custkey % 13 = 0 then null else lpad(o_custkey::varchar, 14, '0') end doc,
  case when o_custkey % 5 = 0 then 'ISENTO' else 'IE' || o_custkey end state_reg,
  case when o_custkey % 21 <> 0 then c_name end trade_name,
  'Rua ' || o_custkey street,
  (['ANGRA DOS REIS, RJ','Volta Redonda, RJ','RIO DE JANEIRO, RJ','Petrópolis, RJ','São Paulo, SP',
    ' Paraty, RJ ','Niterói, RJ','Belo Horizonte, MG'])[c_nationkey % 8 + 1] city_uf,
  lpad(o_custkey::varchar, 8, '0') zip, '' coordinates, 'neg-' || o_orderkey business_id,
  case when o_custkey % 3 = 0 then {dotted("o_custkey")} when o_custkey % 17 = 0 then 'acct-' || o_custkey
    else lpad(o_custkey::varchar, 14, '0') end account_id,
  case when o_orderkey % 4 <> 0 then o_custkey::varchar end codcli,
  '+55(21)9' || substr(lpad(o_custkey::varchar, 8, '0'),1,4) || '-' || substr(lpad(o_custkey::varchar, 8, '0'),5,4) || '.0' phone_1,
  case when o_custkey % 4 <> 0 then '+5521 ' || lpad(o_custkey::varchar, 8, '0') end phone_2,
  case when o_custkey % 6 <> 0 then 'c' || o_custkey || '@example.com' end email_1, '' email_2,
  o_orderdate + to_seconds(o_orderkey % 86400) collected_at
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
    "oi": f"""
select lineitem.*, l_partkey::varchar sku, round(l_extendedprice*100)::bigint price_cents,
  {usd("round(l_extendedprice*100)::bigint")} price,
  case when l_partkey % 50 = 0 then '0' when l_partkey % 51 = 0 then '' else l_quantity::bigint::varchar end quantity,
  case when l_partkey % 50 = 0 or l_partkey % 51 = 0 then 0 else l_quantity::bigint end q,
  'Produto ' || l_partkey product_name, hdr.*
from lineitem join hdr on l_orderkey = o_orderkey""",
    "heads": f"""
select * from (select *, row_number() over (partition by order_no order by {ORD}) rn from oi) where rn = 1""",
    "pos": f"select *, row_number() over (partition by order_no order by {ORD}) - 1 item_pos from oi",
    "clients": """
select unnest(case when c_custkey % 29 = 0 then [c_custkey, c_custkey + 1000000] else [c_custkey] end)::varchar codcli,
  c_name cliente, case when c_custkey % 19 <> 0 then lpad(c_custkey::varchar, 14, '0') end doc,
  case when c_custkey % 20 = 0 then 'S' else 'N' end bloqueio,
  case when c_custkey % 23 <> 0 then round(c_acctbal*100)::bigint * 60 end lim_cents, s.source
from customer, (values ('erp-1'), ('erp-2')) s(source) where s.source = 'erp-1' or c_custkey % 3 <> 2""",
    "recv": """
select case when o_orderkey % 2 = 0 then 'erp-1' else 'erp-2' end source, o_custkey::varchar codcli,
  round(o_totalprice*100)::bigint val, case o_orderstatus when 'P' then '0' when 'F' then '1' end vpago
from orders""",
    "debts": """
select source, codcli, sum(val)::bigint valor_cents from recv where vpago is null or vpago = '0' group by all""",
    "reg": """
select c_custkey, lpad(c_custkey::varchar, 14, '0') cnpj, c_name nome,
  case when c_custkey % 9 <> 0 then 'Loja ' || c_custkey end nome_fantasia,
  case when c_custkey % 11 = 0 then 'Baixada' when c_custkey % 11 <> 1 then 'Ativa' end status,
  'Cidade ' || (c_custkey % 50) cidade, (['RJ','SP','MG','ES'])[c_custkey % 4 + 1] uf,
  case c_custkey % 6 when 0 then 'Não habilitada' when 1 then 'Não encontrada' when 2 then null
    else 'Sem restrição' end ie_status
from customer where c_custkey % 4 <> 3""",
    "problems": """
select cnpj, status, ie_status from reg
where status <> 'Ativa' or ie_status not in ('Sem restrição', 'Não encontrada')""",
    "ev": """
select event_id, 'B' || (user_id % 5) branch, user_id, user_id::varchar codcli, ts, ts::date as day, event_type from events""",
    "led": """
select branch, codcli, day sent_day, strftime(min(ts), '%H:%M:%S') sent_time, null::date greeted_day
from ev where event_id % 2 = 0 group by branch, codcli, day
union all
select branch, '__saudacao__', day, strftime(min(ts), '%H:%M:%S'), day
from ev where event_id % 2 = 0 and event_type = 'error' group by branch, day""",
    "q": "select o_orderkey::varchar order_no, o_orderdate sent_at from orders where o_orderkey % 7 = 0",
    "stored": f"""
select * from (select *, row_number() over (partition by order_no, sku order by {ORD}) rn
  from oi where o_orderkey % 3 <> 0) where rn = 1""",
    "lst": """
select case when o_orderkey % 2 = 0 then 'north' else 'south' end branch, o_orderkey::varchar order_no,
  unnest(case when o_orderkey % 10 = 0 then [o_orderkey, o_orderkey + 1000000] else [o_orderkey] end) pos,
  o_orderkey, o_orderdate, round(o_totalprice*100)::bigint total_cents
from orders where o_orderstatus = 'P' and o_orderkey % 97 <> 0""",
    "pages1": """select * from heads where o_orderstatus = 'P'""",
    "listed": """
select h.* from pages1 h where exists (select 1 from lst where lst.order_no = h.order_no)""",
    "centers": "select * from (values ('CD-0','A'),('CD-1','A'),('CD-2','B'),('CD-3','B')) c(center, branch)",
    "requests": f"""
select * from (select oi.* exclude (branch), c.branch cbranch,
    row_number() over (partition by c.branch, oi.doc order by order_no, {ORD}) rd,
    row_number() over (partition by c.branch, order_no order by {ORD}) ro
  from oi join centers c on oi.center = c.center where doc is not null)""",
    "csrc": "select * from (values ('A','erp-1'),('B','erp-2')) c(branch, source)",
    "gap_rows": f"""
select cbranch branch, c.codcli, r.order_no, total_cents, {PAY_CASE} payment, bloqueio, lim_cents, valor_cents, rd
from requests r join csrc s on s.branch = cbranch
join clients c on c.source = s.source and c.doc = r.doc
left join debts d on d.source = c.source and d.codcli = c.codcli
where ro = 1""",
    "gap": """
select codcli, sum(total_cents)::bigint total_cents, arg_min(payment, order_no) payment, branch
from gap_rows where rd = 1 group by branch, codcli
having coalesce(any_value(lim_cents), 0) - coalesce(any_value(valor_cents), 0) < sum(total_cents)
  or any_value(bloqueio) = 'S'""",
    "acct": """
select distinct upper(replace(replace(replace(account_id, '.', ''), '/', ''), '-', '')) cnpj from oi
where regexp_full_match(replace(replace(replace(account_id, '.', ''), '/', ''), '-', ''), '[0-9]+')
  and length(replace(replace(replace(account_id, '.', ''), '/', ''), '-', '')) > 11""",
    "city": """
select order_no, upper(trim(city_uf)) city, document from heads""",
    "routes": """
select order_no, case when city like '%ANGRA DOS REIS%' or city like '%VOLTA REDONDA%' or city like '%PARATY%' then 'regional'
  when not (city like '%PARATY%' or city like '%PETRÓPOLIS%' or city like '%ANGRA DOS REIS%')
    and document like '%CPF%' and city like '%RJ%' then 'general' end route
from city where order_no not in (select order_no from q)""",
    "lines": """
select *, '*Produto*: ' || product_name || ' | Quantidade: ' || q || ' | ' || case when q <> 0
   then 'Preço Unitário: R$' || (((2*price_cents + q) // (2*nullif(q,0))) // 100)::varchar || '.'
     || lpad((((2*price_cents + q) // (2*nullif(q,0))) % 100)::varchar, 2, '0')
   else 'Preço Total: R$' || (price_cents // 100)::varchar || '.' || lpad((price_cents % 100)::varchar, 2, '0')
     || ' (Quantidade zero)' end || chr(10) line
from oi""",
    "messages": f"""
select order_no, 'order' kind, null::bigint line_no, '*Número Pedido*: *' || order_no || '*' || chr(10)
  || '*Responsavel*: ' || any_value(responsible) || chr(10)
  || '*Documento*: ' || any_value(document) || chr(10)
  || '*Estabelecimento*: ' || coalesce(any_value(trade_name), '') || chr(10)
  || coalesce('*Email*: ' || any_value(email_1) || chr(10), '')
  || '*Telefone 1*: 219' || any_value(zip) || chr(10)
  || case when any_value(o_custkey) % 4 <> 0 then '*Telefone 2*: 21 ' || any_value(zip) || chr(10) else '' end
  || '*Forma de Pagamento*: ' || any_value(payment) || chr(10)
  || '*Total Pedido*: ' || any_value(order_total) || chr(10)
  || '*Endereço de Entrega*: ' || any_value(street) || chr(10)
  || '*Cidade/UF*: ' || upper(trim(any_value(city_uf))) || chr(10)
  || '*CEP*: ' || any_value(zip) || chr(10)
  || '*Data Entrega*: ' || any_value(delivery_date) || chr(10) as text
from lines group by order_no
union all
select order_no, 'line', l_linenumber::bigint, line from lines""",
    "routed": """
select 'chat-regional' target, 0 seq, 'greeting' kind, null::varchar order_no, null::bigint line_no, 'Bom dia! Pedidos sendo enviados!' as text
where exists (select 1 from routes where route = 'regional')
union all
select 'chat-regional', case kind when 'order' then 1 else 2 end, kind, order_no, line_no, text from messages
where order_no in (select order_no from routes where route = 'regional')""",
    "fresh_gap": """
select g.*, (codcli::bigint % 5 = 0 and codcli::bigint < 1000000) as done from gap g""",
    "credit_rows": f"""
select distinct branch, 'chat-a' target, 0 seq, 'greeting' kind, null::varchar codcli,
  'Bom dia, Ana! Seguem os clientes para solicitação de limite:' as text from fresh_gap where branch = 'A'
union all
select branch, case branch when 'A' then 'chat-a' else 'chat-b' end, 1, 'request', codcli,
  '👤 *Cod Cliente:* ' || codcli || chr(10) || '💰 *Valor do Pedido:* R$ ' || {plain("total_cents")} || chr(10)
  || '💳 *Forma de Pagamento:* ' || payment || chr(10) from fresh_gap where not done
union all
select distinct branch, case branch when 'A' then 'chat-a' else 'chat-b' end, 2, 'closing', null,
  'Poderia liberar o limite para esses clientes, por favor? Obrigado!' from fresh_gap where not done""",
    "codes": """
select order_no, h.branch, max(c.codcli) codcli from heads h
join (values ('north','erp-1'),('south','erp-2')) s(branch, source) on h.branch = s.branch
join clients c on c.source = s.source and c.doc = regexp_replace(h.document, '[^0-9]', '', 'g')
group by order_no, h.branch""",
    "page_rows": """
select order_no, trade_name, row_number() over (order by order_no) - 1 n, count(*) over () total from heads""",
    "shown": f"""
select order_no, case when order_date = '' then '—' else substr(order_date,9,2) || '/' || substr(order_date,6,2) || '/' || substr(order_date,1,4) end ordered,
  coalesce(trade_name, '—') customer, branch, coalesce(codcli, '') codcli, coalesce(nullif(doc, ''), '—') document, center,
  case when delivery_date = '' then '—' when contains(delivery_date, '/') then delivery_date
    else substr(delivery_date,9,2) || '/' || substr(delivery_date,6,2) || '/' || substr(delivery_date,1,4) end delivery,
  case when payment like 'Pix%' then 'PIX' when payment like 'Cart%' then 'Cartão' else payment end payment,
  case when payment like 'Pix%' then 'badge-green' when payment = 'Dinheiro' then 'badge-blue'
    when payment like 'Cart%' then 'badge-yellow' else 'badge-gray' end payment_class,
  case status when 'Cancelado' then 'badge-red' else 'badge-green' end status_class,
  {brl("br_cents")} total
from (select *, (cast(replace(replace(replace(order_total, '$', ''), '.', ''), ',', '.') as decimal(18,2)) * 100)::bigint br_cents from heads)""",
    "snap": """
select branch, order_no, sku, price, quantity from stored
where order_no in (select order_no from lst)
union all
select branch, order_no, sku, price, quantity from (
  select *, row_number() over (partition by order_no, sku order by l_orderkey, l_linenumber, l_suppkey, l_partkey, l_shipdate, l_extendedprice) rk
  from oi where o_orderkey % 3 = 0 and order_no in (select order_no from lst)) where rk = 1""",
}

BRANCHES = "(values ('RJ-1','RJ','erp-1'),('SP-1','SP','erp-2'),('MG-1','MG','erp-1')) s(branch, uf, source)"
STAMP = "'%Y-%m-%d %H:%M:%S'"

SQL = {
    "scan_order_items": f"select branch, order_no, sku, price, quantity, quantity quantity_prepared, product_name, "
                        f"{HEADER.replace(', branch', '')}, coordinates, strftime(collected_at, {STAMP}) collected_at from oi",
    "scan_erp_clients": f"""select codcli, cliente, case when doc is not null then substr(doc,1,12) || '-' || substr(doc,13,2) end cgcent,
 bloqueio, {plain("lim_cents")} limcred from clients""",
    "scan_erp_open_orders": "select null::varchar numpedcli from orders where o_orderkey % 3 <> 0",
    "scan_erp_receivables_sum": "select codcli, sum(val)::bigint valor_cents from recv where vpago is null or vpago = '0' group by codcli",
    "multi_source_union": """select codcli, substr(doc,1,12) || '-' || substr(doc,13,2) cgcent, b.branch from clients
 join (values ('north','erp-1'),('south','erp-2'),('outlet','erp-1')) b(branch, source) on b.source = clients.source""",
    "scan_registry_csv": "select cnpj, nome, nome_fantasia, status, cidade, uf, ie_status from reg",
    "scan_order_csvs": """select order_no, sku, price, quantity, nullif(document, '') document, city_uf, trade_name from
 (select * replace (nullif(quantity, '') as quantity) from oi)""",
    "scan_sent_registry": "select order_no from q",
    "scan_company_json": "select lpad(c_custkey::varchar, 14, '0') cnpj, 'Empresa ' || c_custkey nome from customer",
    "explode_ledger_json": """select branch, unnest([codcli, (user_id + 1)::varchar]) codcli, day sent_day,
 strftime(ts, '%H:%M:%S') sent_time, day greeted_day from ev""",
    "scan_listing_snapshot": f"""select branch, pos, order_no, o_orderdate::date::varchar order_date, 'x' delivery_date,
 'Resp' responsible, {usd("total_cents")} order_total from lst""",
    "scan_detail_snapshot": """select branch, order_no, case when o_orderkey % 9 <> 0 then status end status, center, document tax_text,
 8::bigint labels, (select count(*) from oi where oi.order_no = p.order_no)::bigint items from pages1 p""",

    "insert_ignore_items": f"""select branch, order_no, sku, price, quantity, coalesce(trade_name, '') trade_name, coalesce(phone_2, '') phone_2
 from (select *, row_number() over (partition by order_no, sku order by {ORD}) rn from oi) where rn = 1""",
    "upsert_company": """with b as (select lpad(c_custkey::varchar, 14, '0') cnpj, 'Nova ' || c_custkey nome,
   case when c_custkey % 2 = 0 then 'Suspensa' end status from customer where c_custkey % 4 >= 2 and c_custkey % 37 <> 0)
 select coalesce(r.cnpj, b.cnpj) cnpj, case when b.cnpj is not null then b.nome else r.nome end nome, nome_fantasia,
   case when b.cnpj is not null then b.status else r.status end status, ie_status,
   case when r.cnpj is not null then '2024-01-01 00:00:00' else '2024-01-10 09:30:00' end consultado_em
 from reg r full join b on r.cnpj = b.cnpj""",
    "delete_inactive": "select branch, order_no, sku from oi where branch <> 'north' or order_no in (select order_no from lst)",
    "update_codcli": "select oi.order_no, sku, coalesce(c.codcli, oi.codcli) codcli from oi left join codes c on oi.order_no = c.order_no",
    "delete_orders": "select order_no, sku from oi where not (center in ('CD-0','CD-1','CD-2') and document like '%CPF%')",
    "mark_dispatched": f"""select order_no, strftime(sent_at, {STAMP}) sent_at from q union all
 select order_no, '2024-01-10 09:30:00' from hdr where o_orderstatus = 'P' and order_no not in (select order_no from q)""",
    "drain_queue": f"select order_no, strftime(sent_at, {STAMP}) sent_at from q where order_no not in (select order_no from hdr where o_orderstatus = 'P')",
    "ledger_upsert_greeting": """with g as (select branch, '__saudacao__' codcli, day sent_day, strftime(max(ts), '%H:%M:%S') sent_time, day greeted_day
   from ev where event_type = 'error' group by branch, day)
 select * from g union all select led.* from led anti join g on led.branch = g.branch and led.codcli = g.codcli and led.sent_day = g.sent_day""",
    "ledger_insert_client": """with n as (select branch, codcli, day sent_day, strftime(min(ts), '%H:%M:%S') sent_time, null::date greeted_day
   from ev group by branch, codcli, day)
 select * from led union all select n.* from n anti join led on led.branch = n.branch and led.codcli = n.codcli and led.sent_day = n.sent_day""",
    "sent_registry_write": """select order_no, '["' || order_no || '"]' doc from q""",
    "schema_evolve": "select order_no, sku, null::varchar codcli, null::varchar contact_3, center from oi",
    "orders_json": """select order_no, 'order' kind, null::bigint line_no, order_total, trade_name, null::varchar sku, null::varchar price
 from heads union all select order_no, 'item', l_linenumber::bigint, null, null, sku, price from oi""",
    "outbox": """select target, order_no as key, text, kind, seq, line_no from routed union all
 select target, codcli, text, kind, seq, null from credit_rows""",

    "rename_labels": 'select order_no "Numero Pedido", sku "SKU", price "Preço", center "Centro de Distribuição", branch from oi',
    "rename_columns": "select cnpj, nome, nome_fantasia, status, ie_status from reg",
    "drop_columns": "select cnpj, nome, nome_fantasia, cidade from reg",
    "add_literal": "select o_orderkey, 'north' filial from orders",
    "upper_columns": 'select order_no "ORDER_NO", sku "SKU", branch "BRANCH" from oi',
    "fill_trade_name": "select cnpj, coalesce(nome_fantasia, nome) nome_fantasia from reg",
    "payment_code": f"select order_no, sku, {PAY_CASE} payment from oi",
    "center_code": """select order_no, sku, case when center in ('CD-0','CD-1') then 'A' else 'B' end branch,
 case center when 'CD-1' then 'ERP1' when 'CD-3' then 'ERP3' else center end center from oi""",
    "doc_from_labels": "select order_no, case when document <> '' then document end document from pages1",
    "state_reg_from_labels": "select order_no, case when o_orderkey % 3 = 0 then '123' else 'ISENTO' end state_reg from pages1",
    "address_split": """select order_no, street, case when o_orderkey % 4 <> 0 then trim(city_uf) else '' end city_uf,
 case when o_orderkey % 4 <> 0 then zip else '' end zip, '' coordinates from listed""",
    "contacts_split": "select order_no, phone_1, phone_2, coalesce(email_1, 'listed') email_1, null::varchar email_2 from listed",
    "header_fallback": f"""select order_no, case when o_orderkey % 5 = 0 then 'listed' else payment end payment,
 case when o_orderkey % 9 <> 0 then status else 'listed' end status, center, coalesce(trade_name, 'listed') trade_name,
 business_id, account_id, order_total from listed""",
    "explode_items": """select p.order_no, item_pos::bigint item_pos, sku, product_name, price, quantity,
 case when o_orderkey % 9 <> 0 then status else 'listed' end status
 from pos p where o_orderstatus = 'P' and sku <> '7' and order_no in (select order_no from lst)""",
    "filter_status_active": "select cnpj, status from reg where status = 'Ativa'",
    "filter_centers": "select order_no, sku, center from oi where center in ('CD-0','CD-1','CD-2')",
    "personal_document": "select order_no, sku, document from oi where document like '%CPF%'",
    "filter_state": f"select cnpj, reg.uf, s.branch from reg join {BRANCHES} on s.uf = reg.uf",
    "company_problem": "select * from problems",
    "credit_predicate": """select * from (select c_custkey, round(c_acctbal*100)::bigint available_cents, c_custkey * 500 total_cents,
 case c_custkey % 20 when 0 then 'S' when 1 then null else 'N' end blocked from customer)
 where available_cents < total_cents or coalesce(blocked = 'S', false)""",
    "business_hours": "select event_id, isodow(ts) <= 5 and hour(ts) >= 9 and hour(ts) < 18 as open from ev",
    "point_lookup": """select order_no, 'order' kind, null::bigint line_no, null::varchar sku, trade_name from heads where order_no = '77'
 union all select order_no, 'item', l_linenumber::bigint, sku, null from oi where order_no = '77'""",
    "search_orders": """select order_no, document, branch from heads where branch = 'north' and
 (lower(document) like '%cpf%' or lower(coalesce(trade_name, '')) like '%cpf%' or lower(responsible) like '%cpf%')""",
    "valid_tax_number": """select order_no, regexp_full_match(regexp_replace(account_id, '[./-]', '', 'g'), '[0-9]+')
 and length(regexp_replace(account_id, '[./-]', '', 'g')) > 11 valid from hdr""",
    "pending_status": "select order_no, status from heads where status = 'A ser preparado'",
    "pending_preparation": """select order_no, case status when 'Entregue' then 'To be prepared' else status end status
 from heads where status in ('A ser preparado', 'Entregue')""",
    "drop_null_match": "select p.cnpj, h.order_no from problems p join heads h on h.account_id = p.cnpj",

    "codcli_lookup": "select * from codes",
    "registry_erp_match": f"""select cnpj, nome, cidade, reg.uf, c.codcli, s.branch from reg join {BRANCHES} on s.uf = reg.uf
 left join clients c on c.source = s.source and c.doc = reg.cnpj where status = 'Ativa'""",
    "fiscal_pending_orders": "select p.*, h.order_no, h.account_id from problems p join heads h on h.account_id = p.cnpj",
    "fiscal_pending_orders_clean": """select p.*, h.order_no, h.account_id from problems p
 join heads h on regexp_replace(h.account_id, '[./-]', '', 'g') = p.cnpj""",
    "clients_with_debt": """select c.source, c.codcli, cliente, valor_cents from clients c
 left join debts d on c.source = d.source and c.codcli = d.codcli""",
    "erp_presence_join": "select order_no, center, null::varchar numpedcli from heads",
    "exclude_orders_in_erp": "select order_no, center from heads where o_orderkey % 3 <> 0",
    "order_client_join": """select cbranch branch, r.doc doc_key, order_no, c.codcli, bloqueio from requests r
 join csrc s on s.branch = cbranch join clients c on c.source = s.source and c.doc = r.doc where rd = 1""",
    "new_orders": "select branch, order_no, min(pos) pos from lst where order_no not in (select order_no from stored) group by all",
    "unknown_companies": "select cnpj from acct where cnpj not in (select cnpj from reg)",
    "not_sent": "select order_no, branch from hdr where o_orderkey % 7 <> 0",
    "not_notified_today": """select distinct branch, codcli, day from ev anti join led
 on led.branch = ev.branch and led.codcli = ev.codcli and led.sent_day = ev.day""",
    "greeted_today": "select distinct branch, day from ev where (branch, day) in (select (branch, greeted_day) from led where greeted_day is not null)",
    "route_match": """select order_no, city like '%ANGRA DOS REIS%' or city like '%VOLTA REDONDA%' or city like '%PARATY%' regional,
 city like '%PARATY%' or city like '%PETRÓPOLIS%' or city like '%ANGRA DOS REIS%' interior from city""",
    "source_dedup": """select b.branch, b.source, codcli from clients
 join (values ('north','erp-1'),('south','erp-2'),('outlet','erp-1')) b(branch, source) on b.source = clients.source""",

    "orders_grouped": f"""select order_no, 'order' kind, null::bigint line_no, {HEADER}, null::varchar sku, null::varchar price,
 null::varchar quantity from heads union all
 select order_no, 'item', l_linenumber::bigint, {', '.join('null' for _ in HEADER.split(', '))}, sku, price, quantity from oi""",
    "orders_grouped_flat": """select order_no, l_linenumber::bigint line_no, sku, product_name, price, quantity, quantity quantity_prepared,
 trade_name, document, order_total from oi""",
    "order_documents": f"""select order_no, arg_min_null(trade_name, p) trade_name, arg_min(order_total, p) order_total, count(*) items,
 arg_min_null(sku, p) first_sku, arg_max_null(price, p) last_price
 from (select *, row_number() over (order by {ORD}) p from oi) group by order_no""",
    "credit_gap": "select * from gap",
    "credit_gap_all_orders": """select codcli, sum(total_cents)::bigint total_cents, arg_min(payment, order_no) payment, branch
 from gap_rows group by branch, codcli
 having coalesce(any_value(lim_cents), 0) - coalesce(any_value(valor_cents), 0) < sum(total_cents) or any_value(bloqueio) = 'S'""",
    "credit_gap_without_erp_orders": """select codcli, sum(total_cents)::bigint total_cents, arg_min(payment, order_no) payment, branch
 from gap_rows where rd = 1 and order_no::bigint % 3 <> 0 group by branch, codcli
 having coalesce(any_value(lim_cents), 0) - coalesce(any_value(valor_cents), 0) < sum(total_cents) or any_value(bloqueio) = 'S'""",
    "credit_rejected_totals": "select count(*) filter (total_cents is null) rejected, count(*) as rows from oi",
    "receivables_sum": "select * from debts",
    "order_stats": """select count(*) orders, (sum(cast(replace(replace(replace(order_total, '$', ''), '.', ''), ',', '.') as decimal(18,2))) * 100)::bigint value_cents from heads""",
    "order_stats_us": "select count(*) orders, sum(total_cents)::bigint value_cents from heads",
    "orders_per_branch": "select branch, count(*) orders from heads group by branch",
    "last_update": "select strftime(max(collected_at), '%H:%M:%S') last_update from oi",
    "distinct_orders": "select distinct order_no from oi where branch = 'north'",
    "distinct_companies": "select cnpj from acct",
    "known_companies": "select cnpj from reg",
    "queue_orders": "select order_no from q",
    "any_eligible": "select count(route) > 0 eligible from routes",
    "order_message_lines": "select order_no, l_linenumber::bigint line_no, line as text from lines",
    "run_counts": """select 'items' stage, count(*) as rows from oi union all select 'orders', count(distinct order_no) from oi
 union all select 'companies', count(*) from acct
 union all select 'unknown companies', count(*) from acct where cnpj not in (select cnpj from reg)
 union all select 'company problems', count(*) from problems union all select 'queue', count(*) from q""",
    "branch_cards": """select b.branch, count(h.order_no) orders from (values ('north'),('south'),('outlet'),('west')) b(branch)
 left join heads h on h.branch = b.branch group by b.branch""",
    "order_number_list": """select null::varchar order_no, count(distinct order_no) orders from oi
 union all select distinct order_no, null::bigint from oi""",
    "items_per_order": "select order_no, count(*) items from oi group by order_no",

    "first_row_per_order": "select order_no, sku, price from heads",
    "first_row_per_document": f"""select branch, doc, order_no, sku from
 (select *, row_number() over (partition by branch, doc order by order_no, {ORD}) rn from oi) where rn = 1""",
    "dedupe_listing": "select branch, order_no, min(pos) pos from lst group by all",
    "first_value_header": "select order_no, trade_name, responsible, sku, phone_2 from heads",
    "sort_orders": "select order_no, order_total from hdr order by order_no",
    "paginate": """select order_no, trade_name, 3::bigint page, ((total + 19) // 20)::bigint pages, 41::bigint first, 60::bigint as last,
 total from page_rows where n between 40 and 59""",
    "paginate_clamped": """select order_no, trade_name, ((total + 19) // 20)::bigint page, ((total + 19) // 20)::bigint pages,
 ((total - 1) // 20 * 20 + 1)::bigint first, total::bigint as last, total from page_rows where n >= (total - 1) // 20 * 20""",
    "paginate_late": """select order_no, trade_name, page, pages, (20 * page - 19)::bigint first, least(20 * page, total)::bigint as last, total
 from (select *, ((total + 19) // 20)::bigint pages, least(51, (total + 19) // 20)::bigint page from page_rows)
 where n // 20 + 1 = page""",
    "exists_limit_1": """select distinct branch, day, (branch, day) in (select (branch, greeted_day) from led where greeted_day is not null) greeted from ev""",
    "union_by_name": """select order_no, codcli, null::varchar city_uf from hdr where branch = 'north'
 union all select order_no, null, city_uf from hdr where branch = 'south'""",
    "difference": "select branch, order_no from lst except select branch, order_no from stored",
    "distinct": "select distinct account_id from oi",

    "digits_only": "select order_no, sku, regexp_replace(document, '[^0-9]', '', 'g') digits from oi",
    "clean_tax_punct": "select order_no, sku, upper(trim(regexp_replace(account_id, '[./-]', '', 'g'))) tax from oi",
    "parse_money_br": """select order_no, sku, (try_cast(replace(replace(replace(price, '$', ''), '.', ''), ',', '.') as decimal(18,2)) * 100)::bigint br_cents from oi""",
    "parse_money_us": "select order_no, sku, price_cents us_cents, 0::bigint zero_cents from oi",
    "to_number_or_zero": "select order_no, sku, q quantity from oi",
    "doc_number": "select order_no, sku, doc doc_number from oi",
    "doc_type": "select order_no, sku, split_part(document, ':', 1) doc_type from oi",
    "format_document": "select order_no, sku, coalesce(doc, '—') document from oi",
    "clean_phone": """select order_no, sku, '219' || zip phone_1, case when o_custkey % 4 <> 0 then '21 ' || zip end phone_2 from oi""",
    "format_date_br": """select oi.order_no, sku, ordered, delivery from oi join shown s on s.order_no = oi.order_no""",
    "format_brl": f"select c_custkey, {brl('round(c_acctbal*100)::bigint')} shown from customer",
    "format_total": f"""select oi.order_no, sku, s.total, case when quantity = '' then '—' else {brl('(q*100)')} end quantity
 from oi join shown s on s.order_no = oi.order_no""",
    "payment_family": "select oi.order_no, sku, s.payment family from oi join shown s on s.order_no = oi.order_no",
    "payment_badge": "select oi.order_no, sku, s.payment_class badge from oi join shown s on s.order_no = oi.order_no",
    "status_badge": "select oi.order_no, sku, s.status_class badge from oi join shown s on s.order_no = oi.order_no",
    "unit_price": """select order_no, sku, l_linenumber as line, ((2*price_cents + q) // (2*nullif(q,0)))::bigint unit_cents, q = 0 zero_quantity from oi""",
    "fixed2": f"select c_custkey, {plain('round(c_acctbal*100)::bigint')} shown from customer",
    "day_greeting": """select event_id, g || '!' plain, g || ', ' || codcli named from (select *, case when hour(ts) between 5 and 11 then 'Bom dia'
 when hour(ts) between 12 and 17 then 'Boa tarde' else 'Boa noite' end g from ev)""",
    "upper_trim_city": "select order_no, upper(trim(city_uf)) city from hdr",
    "time_text": "select event_id, strftime(ts, '%H:%M:%S') as at from ev",
    "null_to_dash": "select order_no, coalesce(trade_name, '—') trade_name, coalesce(nullif(document, ''), '—') document from hdr",
    "key_text": "select o_orderkey::varchar order_no, o_custkey::varchar codcli from orders",

    "flatten_company": """select lpad(c_custkey::varchar, 14, '0') cnpj, 'Empresa ' || c_custkey nome,
 case c_custkey % 3 when 0 then null when 1 then 'Não disponível' else 'Loja ' || c_custkey end nome_fantasia,
 (c_custkey * 1000)::varchar || '.50' capital_social, 'N/D' natureza_juridica, 'ME' tamanho, '2001-02-03' data_fundacao,
 'Ativa' status, null::varchar data_status, 'Não disponível' razao_status,
 case c_custkey % 3 when 0 then 'N/D' when 1 then '(21) ' || c_custkey else '(21) ' || c_custkey || ', (22) ' || c_custkey end telefone,
 'e' || c_custkey || '@example.com' email, case when c_custkey % 4 = 0 then 'N/D' else 'Varejo' end atividade_principal,
 'Nenhuma' atividades_secundarias, case when c_custkey % 2 = 0 then 'True' else 'False' end simples_optante, null::varchar simei_optante,
 'Rua ' || c_custkey rua, 'Não disponível' numero, null::varchar complemento, 'Não disponível' bairro, 'Niterói' cidade, 'RJ' uf,
 'Não disponível' cep, case when c_custkey % 5 = 0 then 'Não encontrada' else 'RJ' end ie_estado,
 case when c_custkey % 5 = 0 then 'Não encontrada' else c_custkey::varchar end ie_numero,
 case when c_custkey % 5 = 0 then 'Não encontrada' else 'Sem restrição' end ie_status, 'Não encontrada' ie_tipo,
 case when c_custkey % 5 = 0 then 'Não encontrada' end ie_data_status from customer""",
    "join_phones": """select lpad(c_custkey::varchar, 14, '0') asked, case c_custkey % 3 when 0 then 'N/D' when 1 then '(21) ' || c_custkey
 else '(21) ' || c_custkey || ', (22) ' || c_custkey end telefone from customer""",
    "join_emails": "select lpad(c_custkey::varchar, 14, '0') asked, 'e' || c_custkey || '@example.com' email from customer",
    "join_activities": "select lpad(c_custkey::varchar, 14, '0') asked, 'Nenhuma' atividades from customer",
    "first_registration": """select lpad(c_custkey::varchar, 14, '0') cnpj, case when c_custkey % 5 = 0 then 'Não encontrada' else 'RJ' end ie_estado,
 case when c_custkey % 5 = 0 then 'Não encontrada' else c_custkey::varchar end ie_numero,
 case when c_custkey % 5 = 0 then 'Não encontrada' else 'Sem restrição' end ie_status, 'Não encontrada' ie_tipo,
 case when c_custkey % 5 = 0 then 'Não encontrada' end ie_data_status from customer""",
    "ocr_fix": f"""select o_orderkey::varchar order_no, 'DANFE CNPJ ' || {dotted("o_custkey")} || ' CHAVE '
 || regexp_replace(lpad(o_orderkey::varchar, 44, '7'), '(.{{4}})', '\\1 ', 'g')
 || 'VAL0R T0TAL DA N0TA R$ ' || floor(o_totalprice)::bigint || ',00  F1M' body from orders""",
    "extract_tax_ids": f"select o_orderkey::varchar order_no, {dotted('o_custkey')} cnpj, 1::bigint found from orders",
    "extract_total": "select o_orderkey::varchar order_no, floor(o_totalprice)::bigint || ',00' total from orders",
    "extract_access_key": "select o_orderkey::varchar order_no, lpad(o_orderkey::varchar, 44, '7') access_key from orders",
    "extract_from_documents": r"""with d as (select doc_id, replace(translate(text, 'OoI', '001'), '|', '') t from documents)
 select doc_id, coalesce(regexp_extract_all(t, '(\d{2}\.?\d{3}\.?\d{3}/\d{4}-?\d{2})', 1)[1], 'Não encontrado') cnpj,
 coalesce(list_filter(list_transform(regexp_extract_all(t, '([\d\s]{40,65})', 1), lambda k: regexp_replace(k, '[^0-9]', '', 'g')), lambda k: length(k) = 44)[1], 'Não encontrada') access_key,
 length(t) chars from d""",
    "labels_slice": """select order_no, (1 + (phone_2 is not null)::int)::bigint texts, phone_1 || coalesce('|' || phone_2, '') phones from pages1""",

    "reconcile_snapshot": "select * from snap",
    "reconcile_pages": f"""select branch, order_no, sku, quantity, state_reg, responsible from stored
 where order_no in (select order_no from lst)
union all
select branch, order_no, sku, quantity, case when o_orderkey % 3 = 0 then '123' else 'ISENTO' end, 'Resp' from (
  select *, row_number() over (partition by order_no, sku order by {ORD}) rk from oi
  where o_orderkey % 3 = 0 and sku <> '7' and order_no in (select order_no from lst)) where rk = 1""",
    "cpf_reject_candidates": """select order_no, center, document, payment, order_total, trade_name, responsible from heads
 where center in ('CD-0','CD-1','CD-2') and document like '%CPF%'""",
    "fiscal_reject_candidates": "select h.order_no, p.cnpj from problems p join heads h on h.account_id = p.cnpj",
    "company_backfill": """select cnpj, nome, nome_fantasia, status, cidade, uf, ie_status, '2024-01-01 00:00:00' consultado_em from reg
union all
select a.cnpj, 'Empresa ' || a.cnpj::bigint, case a.cnpj::bigint % 3 when 0 then null when 1 then 'Não disponível' else 'Loja ' || a.cnpj::bigint end,
 'Ativa', 'Niterói', 'RJ', case when a.cnpj::bigint % 5 = 0 then 'Não encontrada' else 'Sem restrição' end, '2024-01-10 09:30:00'
from acct a where a.cnpj not in (select cnpj from reg)""",
    "route_orders": "select * from routes",
    "route_orders_default_cities": """select order_no, case when city like '%ANGRA DOS REIS%' or city like '%VOLTA REDONDA%' or city like '%PARATY%' then 'regional'
  when city not like '%PETRÓPOLIS%' and document like '%CPF%' and city like '%RJ%' then 'general' end route
from city where order_no not in (select order_no from q)""",
    "credit_outbox": "select * from credit_rows",
    "credit_ledger_after": """select b.branch, c_custkey::varchar codcli, date '2024-01-10' sent_day, '08:00:00' sent_time, null::date greeted_day
 from customer, (values ('A'), ('B')) b(branch) where c_custkey % 5 = 0
union all select 'B', '__saudacao__', date '2024-01-10', '08:00:00', date '2024-01-10'
union all select branch, case seq when 0 then '__saudacao__' else codcli end, date '2024-01-10', '09:30:00',
 case seq when 0 then date '2024-01-10' end from credit_rows where seq < 2""",
    "credit_message": f"""select o_orderkey, '👤 *Cod Cliente:* ' || o_custkey || chr(10) || '💰 *Valor do Pedido:* R$ '
 || {plain("round(o_totalprice*100)::bigint")} || chr(10) || '💳 *Forma de Pagamento:* QR' || chr(10) as text from orders""",
    "order_message": "select * from messages",
    "routed_outbox": "select * from routed",
    "queue_routed": f"""select order_no, strftime(sent_at, {STAMP}) sent_at from q
 union all select order_no, '2024-01-10 09:30:00' from routes where route = 'regional'""",
    "queue_progress": "select order_no from q where order_no not in (select order_no from heads where status = 'A ser preparado')",
    "dashboard_view": """select order_no, ordered, customer, branch, codcli, document, center, delivery, payment, payment_class, status_class, total from
 (select s.*, row_number() over (order by s.order_no) - 1 n from shown s join heads h on h.order_no = s.order_no where h.document like '%CPF%')
 where n between 20 and 39""",
    "dashboard_columns": "select * from shown",

    "stream_insert_ignore": f"""select order_no, sku, price, quantity, coalesce(phone_2, '') phone_2
 from (select *, row_number() over (partition by order_no, sku order by {ORD}) rn from oi) where rn = 1""",
    "stream_daily_once": "select distinct branch, codcli, day from ev",
    "stream_daily_once_watermark": "select distinct branch, codcli, day from ev",
    "stream_daily_once_timed": "select distinct branch, codcli, day from ev",
    "stream_daily_once_exact": "select distinct branch, codcli, day from ev",
    "stream_snapshot_reconcile": "select * from snap",
    "stream_order_stats": f"""select branch, count(*) orders, sum(total_cents)::bigint value_cents,
 strftime(max(collected_at), {STAMP}) last_update from hdr group by branch""",
}


#: Queries that give the rows of another one by other means.
SAME_AS = {
    "insert_ignore_bucketed": "insert_ignore_items", "reconcile_bucketed": "reconcile_snapshot",
    "route_orders_rules": "route_orders", "search_orders_indexed": "search_orders",
    "paginate_stored": "paginate", "stream_order_stats_changes": "stream_order_stats",
}


def _needed(sql: str, found: list[str]) -> list[str]:
    for name, body in BASE.items():
        if name not in found and re.search(rf"\b(?:from|join)\s+{name}\b", sql):
            _needed(body, found)
            if name not in found:
                found.append(name)
    return found


def statement(sql: str) -> str:
    ctes = [f"{name} as ({BASE[name].strip()})" for name in _needed(sql, [])]
    if not ctes:
        return sql
    if sql.startswith("with "):
        return "with " + ",\n".join(ctes) + ",\n" + sql[len("with "):]
    return "with " + ",\n".join(ctes) + "\n" + sql


def statements() -> dict[str, str]:
    own = {name: statement(sql) for name, sql in SQL.items()}
    return own | {name: own[other] for name, other in SAME_AS.items()}
