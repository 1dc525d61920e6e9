"""DuckDB statements that state the result of each registered query on its own terms.

Every oracle is one statement: shared CTEs from the test tables up to the fact, then the
relation in question.
"""

from __future__ import annotations

KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

RAW = r"""
raw_sales as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey,
    case when l_orderkey%173=0 then '' when l_orderkey%179=0 then null
         else cast(l_partkey as varchar) end as raw_id,
    case when l_orderkey%211=0 then null else concat('  ',upper(p_name),' ') end as raw_produto,
    case when l_orderkey%223=0 then null else p_type end as raw_categoria,
    case when l_orderkey%101=0 then 'sob consulta' when l_orderkey%103=0 then null
         else cast(l_extendedprice as varchar) end as raw_preco,
    case when l_orderkey%107=0 then 'gratis' when l_orderkey%109=0 then null
         when l_orderkey%113=0 then concat(cast(cast(l_quantity as int) as varchar),',90')
         else concat('R$ ',cast(l_quantity as varchar)) end as raw_frete,
    case when l_orderkey%127=0 then '31/02/2000' when l_orderkey%131=0 then null
         when l_orderkey%137=0 then strftime(l_shipdate,'%-d/%-m/%Y')
         else strftime(l_shipdate,'%d/%m/%Y') end as raw_data,
    case when l_orderkey%139=0 then null else s_name end as raw_vendedor,
    case when l_orderkey%149=0 then null else concat(chr(65+c_nationkey),'X ') end as raw_local,
    case when l_orderkey%151=0 then '4.5' when l_orderkey%157=0 then null
         else cast(1+l_linenumber%5 as varchar) end as raw_avaliacao,
    case when l_orderkey%163=0 then null else o_orderpriority end as raw_pagamento,
    case when l_linenumber=7 then null else cast(l_linenumber as varchar) end as raw_parcelas,
    case when l_orderkey%167=0 then 'n/d' else cast(c_nationkey*-1.25 as varchar) end as raw_lat,
    cast(-30-c_nationkey*0.5 as varchar) as raw_lon
  from lineitem
  join orders on l_orderkey=o_orderkey
  join customer on o_custkey=c_custkey
  join part on l_partkey=p_partkey
  join supplier on l_suppkey=s_suppkey
)"""

FLOAT = r"'\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*'"
INT = r"'\s*[+-]?\d+\s*'"


def _text(column: str) -> str:
    return f"trim(lower({column}), ' ' || chr(9) || chr(10) || chr(13))"


def _float(column: str) -> str:
    return f"case when regexp_full_match({column}, {FLOAT}) then cast({column} as double) end"


def _cents(number: str) -> str:
    return f"cast(trunc(({number}) * 100) as bigint)"


def _int(column: str, type_name: str = "bigint") -> str:
    return f"case when regexp_full_match({column}, {INT}) then cast({column} as {type_name}) end"


PRODUCT_ID = "nullif(raw_id, '')"
PRICE = _cents(_float("raw_preco"))
SHIPPING = _cents(
    r"try_cast(nullif(regexp_extract(raw_frete, '(\d+\.?\d*|\.\d+)', 1), '') as double)"
)
RATING = _int("raw_avaliacao")
INSTALLMENTS = _int("raw_parcelas")
LATITUDE = f"cast({_float('raw_lat')} as decimal(10,7))"
LONGITUDE = f"cast({_float('raw_lon')} as decimal(10,7))"
DAY = r"""case when regexp_full_match(raw_data, '\d{1,2}/\d{1,2}/\d{4}')
  then cast(try_strptime(raw_data, '%d/%m/%Y') as date) end"""

TEXTS = {
    "product_name": ("raw_produto", "nome indisponível"),
    "category_name": ("raw_categoria", "outros"),
    "seller_name": ("raw_vendedor", "vendedor desconhecido"),
    "purchase_location_code": ("raw_local", "n/a"),
    "payment_type": ("raw_pagamento", "não especificado"),
}
NORMALIZED = ", ".join(f"{_text(raw)} as {name}" for name, (raw, _) in TEXTS.items())
DEFAULTED = ", ".join(
    f"coalesce({_text(raw)}, '{default}') as {name}" for name, (raw, default) in TEXTS.items()
)

STAGING = f"""
stg as (
  select {PRODUCT_ID} as product_id, {DEFAULTED},
    cast({PRICE} as int) as price_cents, cast({SHIPPING} as int) as shipping_cost_cents,
    {DAY} as purchase_date, cast({RATING} as int) as purchase_rating,
    cast({INSTALLMENTS} as int) as installments_quantity,
    {LATITUDE} as latitude, {LONGITUDE} as longitude
  from raw_sales
)"""

CALENDAR = """cast(extract(year from data_completa) as int) as ano,
    cast(extract(month from data_completa) as int) as mes,
    cast(extract(day from data_completa) as int) as dia,
    rpad(dayname(data_completa), 9, ' ') as nome_dia_semana,
    rpad(monthname(data_completa), 9, ' ') as nome_mes,
    cast(extract(quarter from data_completa) as int) as trimestre,
    case when extract(month from data_completa) <= 6 then 1 else 2 end as semestre"""

# Per dimension: key columns in order, the members found in a set of staged rows, the
# match of a staged row s with a member d, and the remaining output columns.
DIMENSIONS = {
    "tempo": {
        "order": "data_completa",
        "members": "select distinct purchase_date as data_completa from {rows} s "
        "where purchase_date is not null",
        "same": "a.data_completa = b.data_completa",
        "match": "s.purchase_date = d.data_completa",
        "columns": f"data_completa, {CALENDAR}",
    },
    "local": {
        "order": "uf",
        "members": "select purchase_location_code as uf, min(latitude) as latitude, "
        "min(longitude) as longitude from {rows} s "
        "where purchase_location_code <> 'n/a' group by 1",
        "same": "a.uf = b.uf",
        "match": "s.purchase_location_code = d.uf",
        "columns": "uf, cast(null as varchar) as regiao, latitude, longitude",
    },
    "vendedor": {
        "order": "nome_vendedor",
        "members": "select distinct seller_name as nome_vendedor from {rows} s "
        "where seller_name <> 'vendedor desconhecido'",
        "same": "a.nome_vendedor = b.nome_vendedor",
        "match": "s.seller_name = d.nome_vendedor",
        "columns": "nome_vendedor",
    },
    "produto": {
        "order": "nome_produto, categoria",
        "members": "select distinct product_name as nome_produto, category_name as categoria "
        "from {rows} s where product_name <> 'nome indisponível' and category_name <> 'outros'",
        "same": "a.nome_produto = b.nome_produto and a.categoria = b.categoria",
        "match": "s.product_name = d.nome_produto and s.category_name = d.categoria",
        "columns": "nome_produto, categoria, cast(null as varchar) as brand",
    },
    "pagamento": {
        "order": "tipo_pagamento, qtd_parcelas nulls last",
        "members": "select distinct payment_type as tipo_pagamento, "
        "installments_quantity as qtd_parcelas from {rows} s "
        "where payment_type <> 'não especificado'",
        "same": "a.tipo_pagamento = b.tipo_pagamento "
        "and a.qtd_parcelas is not distinct from b.qtd_parcelas",
        "match": "s.payment_type = d.tipo_pagamento "
        "and s.installments_quantity is not distinct from d.qtd_parcelas",
        "columns": "tipo_pagamento, qtd_parcelas",
    },
}


def _dimension(name: str) -> str:
    spec = DIMENSIONS[name]
    return f"""
dim_{name} as (
  select cast(row_number() over (order by {spec["order"]}) as int) as sk_{name},
    {spec["columns"]}
  from ({spec["members"].format(rows="stg")}) m
)"""


def _dimension_in_two(name: str) -> str:
    """Members of the early sales first, numbered; then those only the rest has."""
    spec = DIMENSIONS[name]
    early = "(select * from stg where purchase_date < date '1995-01-04')"
    rest = "(select * from stg where purchase_date >= date '1995-01-04' or purchase_date is null)"
    return f"""
first_members as ({spec["members"].format(rows=early)}),
rest_members as (
  select * from ({spec["members"].format(rows=rest)}) a
  where not exists (select 1 from first_members b where {spec["same"]})
),
both_batches as (
  select cast(row_number() over (order by {spec["order"]}) as int) as sk_{name}, *
  from first_members
  union all
  select cast((select count(*) from first_members)
      + row_number() over (order by {spec["order"]}) as int) as sk_{name}, *
  from rest_members
)"""


FACT = f"""
fato as (
  select coalesce(dp.sk_produto, -1) as sk_produto, coalesce(dv.sk_vendedor, -1) as sk_vendedor,
    coalesce(dl.sk_local, -1) as sk_local, coalesce(dt.sk_tempo, -1) as sk_tempo,
    coalesce(dg.sk_pagamento, -1) as sk_pagamento,
    s.price_cents as preco_cents, s.shipping_cost_cents, s.purchase_rating,
    s.price_cents + coalesce(s.shipping_cost_cents, 0) as total_cents
  from stg s
  left join dim_produto dp on {DIMENSIONS["produto"]["match"].replace("d.", "dp.")}
  left join dim_vendedor dv on {DIMENSIONS["vendedor"]["match"].replace("d.", "dv.")}
  left join dim_local dl on {DIMENSIONS["local"]["match"].replace("d.", "dl.")}
  left join dim_tempo dt on {DIMENSIONS["tempo"]["match"].replace("d.", "dt.")}
  left join dim_pagamento dg on {DIMENSIONS["pagamento"]["match"].replace("d.", "dg.")}
  where s.purchase_date is not null
)"""

MEASURES = (
    "sk_produto, sk_vendedor, sk_local, sk_tempo, sk_pagamento, "
    "preco_cents, shipping_cost_cents, purchase_rating"
)
STAGED = (
    "product_id, product_name, category_name, price_cents, shipping_cost_cents, purchase_date, "
    "seller_name, purchase_location_code, purchase_rating, payment_type, "
    "installments_quantity, latitude, longitude"
)


def _from_raw(select: str) -> str:
    return f"with {RAW}\n{select}"


def _from_staging(select: str) -> str:
    return f"with {RAW}, {STAGING}\n{select}"


def _from_warehouse(select: str) -> str:
    dimensions = ", ".join(_dimension(name) for name in DIMENSIONS)
    return f"with {RAW}, {STAGING}, {dimensions}, {FACT}\n{select}"


def _money(column: str) -> str:
    return f"cast(sum({column}) as double) / 100"


def _money_mean(column: str) -> str:
    return f"cast(sum({column}) as double) / nullif(count({column}), 0) / 100"


SALES = f"count(*) as total_transacoes_venda, {_money('total_cents')} as valor_total_vendas"

MARTS = {
    "mart_01_sales_by_category": f"""
select categoria, count(*) as total_transacoes_venda,
  {_money("preco_cents")} as valor_produtos_vendidos,
  {_money("total_cents")} as valor_total_com_frete,
  {_money_mean("total_cents")} as ticket_medio_por_transacao
from fato join dim_produto using (sk_produto) group by categoria
order by valor_total_com_frete desc nulls first, categoria""",
    "mart_02_monthly_sales": f"""
select ano, mes, nome_mes, {SALES} from fato join dim_tempo using (sk_tempo)
group by ano, mes, nome_mes order by ano, mes""",
    "mart_03_top_sellers": f"""
select nome_vendedor, {SALES} from fato join dim_vendedor using (sk_vendedor)
where sk_vendedor <> -1 group by nome_vendedor
order by valor_total_vendas desc nulls first, nome_vendedor limit 10""",
    "mart_04_sales_by_location": f"""
select uf, {SALES},
  cast(sum(purchase_rating) as double) / nullif(count(purchase_rating), 0)
    as avaliacao_media_compra
from fato join dim_local using (sk_local) where sk_local <> -1 group by uf
order by valor_total_vendas desc nulls first, uf""",
    "mart_05_payments": f"""
select tipo_pagamento, coalesce(qtd_parcelas, 0) as quantidade_parcelas, {SALES},
  {_money_mean("total_cents")} as valor_medio_por_transacao
from fato join dim_pagamento using (sk_pagamento) where sk_pagamento <> -1
group by tipo_pagamento, coalesce(qtd_parcelas, 0)
order by tipo_pagamento, quantidade_parcelas""",
    "mart_06_quarterly_sales": f"""
select ano, trimestre, {SALES} from fato join dim_tempo using (sk_tempo)
group by ano, trimestre order by ano, trimestre""",
    "mart_07_rating_by_category": """
select categoria, purchase_rating as avaliacao_da_compra,
  count(*) as total_transacoes_com_esta_avaliacao
from fato join dim_produto using (sk_produto)
where purchase_rating is not null and sk_produto <> -1
group by categoria, purchase_rating order by categoria, avaliacao_da_compra""",
    "mart_08_freight_by_location": f"""
select uf, {_money_mean("shipping_cost_cents")} as frete_medio,
  cast(min(shipping_cost_cents) as double) / 100 as frete_minimo,
  cast(max(shipping_cost_cents) as double) / 100 as frete_maximo,
  {_money("shipping_cost_cents")} as frete_total_uf
from fato join dim_local using (sk_local)
where shipping_cost_cents is not null and sk_local <> -1
group by uf order by frete_medio desc nulls first, uf""",
    "mart_09_weekend_vs_weekday": f"""
select case when extract(dow from data_completa) in (0, 6) then 'Fim de Semana'
    else 'Dia Útil' end as tipo_dia,
  {SALES}, {_money_mean("total_cents")} as ticket_medio_por_transacao
from fato join dim_tempo using (sk_tempo) group by 1 order by 1""",
    "mart_10_top_products": f"""
select nome_produto, categoria, count(*) as total_transacoes_ou_unidades_vendidas,
  {_money("total_cents")} as valor_total_vendas
from fato join dim_produto using (sk_produto) where sk_produto <> -1
group by nome_produto, categoria
order by valor_total_vendas desc nulls first, nome_produto, categoria limit 5""",
    "mart_11_seller_monthly": f"""
select ano, mes, nome_mes, nome_vendedor, {SALES}
from fato join dim_tempo using (sk_tempo) join dim_vendedor using (sk_vendedor)
where sk_vendedor <> -1 group by ano, mes, nome_mes, nome_vendedor
order by ano, mes, nome_vendedor, valor_total_vendas desc nulls first""",
}

RAW_NAMES = {
    "product_name": "raw_produto",
    "category_name": "raw_categoria",
    "price_raw": "raw_preco",
    "shipping_raw": "raw_frete",
    "date_raw": "raw_data",
    "seller_name": "raw_vendedor",
    "purchase_location_code": "raw_local",
    "rating_raw": "raw_avaliacao",
    "payment_type": "raw_pagamento",
    "installments_raw": "raw_parcelas",
    "latitude_raw": "raw_lat",
    "longitude_raw": "raw_lon",
}
RENAMED = f"{PRODUCT_ID} as product_id, " + ", ".join(
    f"{raw} as {name}" for name, raw in RAW_NAMES.items()
)

CONVERTED = {
    "price_cents": ("raw_preco", PRICE),
    "shipping_cost_cents": ("raw_frete", SHIPPING),
    "purchase_rating": ("raw_avaliacao", RATING),
    "installments_quantity": ("raw_parcelas", INSTALLMENTS),
    "latitude": ("raw_lat", LATITUDE),
    "longitude": ("raw_lon", LONGITUDE),
    "purchase_date": ("raw_data", DAY),
}


def _rejected(name: str) -> str:
    raw, converted = CONVERTED[name]
    blank = " and trim(raw_data) <> ''" if name == "purchase_date" else ""
    return f"{raw} is not null{blank} and ({converted}) is null"


REQUIRED = {
    "staging_produtos_ecommerce": ("staging_id", "etl_load_timestamp"),
    "dim_tempo": ("sk_tempo", "data_completa", "ano", "mes", "dia"),
    "dim_local": ("sk_local", "uf"),
    "dim_vendedor": ("sk_vendedor", "nome_vendedor"),
    "dim_produto": ("sk_produto", "nome_produto", "categoria"),
    "dim_pagamento": ("sk_pagamento", "tipo_pagamento"),
    "fato_vendas": (
        "sk_produto",
        "sk_vendedor",
        "sk_local",
        "sk_tempo",
        "sk_pagamento",
        "etl_load_timestamp",
        "sk_venda",
    ),
}
# Generated by the load, so they have no counterpart in the oracle's relations.
GENERATED = {"staging_id", "sk_venda", "etl_load_timestamp"}
RELATIONS = {"staging_produtos_ecommerce": "stg", "fato_vendas": "fato"}


def _nulls(table: str, column: str) -> str:
    place = REQUIRED[table].index(column)
    key = f"sk_{table.removeprefix('dim_')}"
    planted = f"{key} % {place + 2} = 0" if key in REQUIRED[table] and table.startswith("dim_") else (
        f"purchase_rating = {1 + place % 5}"
    )
    test = planted if column in GENERATED else f"{planted} or {column} is null"
    return (
        f"select '{table}' as table_name, '{column}' as column_name, "
        f"count(*) filter (where {test}) as null_rows from {RELATIONS.get(table, table)}"
    )


def _violations(column: str, rule: str, test: str) -> str:
    return (
        f"select '{column}' as column_name, '{rule}' as rule, "
        f"count(*) filter (where {test}) as violations from wide"
    )


def _domain_oracle() -> str:
    ints = {
        "price_cents": PRICE,
        "shipping_cost_cents": SHIPPING,
        "purchase_rating": RATING,
        "installments_quantity": INSTALLMENTS,
    }
    coordinates = {"latitude": _float("raw_lat"), "longitude": _float("raw_lon")}
    lengths = {"category_name": 255, "purchase_location_code": 10, "payment_type": 50}
    wide = f"""
wide as (
  select {DEFAULTED}, {", ".join(f"{sql} as {name}" for name, sql in ints.items())},
    {", ".join(f"{sql} as {name}" for name, sql in coordinates.items())}
  from planted
)"""
    beyond = {
        "raw_preco": (401, "'50000000'"),
        "raw_frete": (409, "'R$ 99999999.99'"),
        "raw_avaliacao": (419, "'99999999999'"),
        "raw_parcelas": (421, "'-99999999999'"),
        "raw_categoria": (431, "repeat('c', 300)"),
        "raw_pagamento": (433, "repeat('p', 51)"),
        "raw_local": (439, "'long place'"),
        "raw_lat": (443, "'1234.5'"),
        "raw_lon": (449, "'-1e9'"),
    }
    replaced = ", ".join(
        f"case when l_orderkey % {n} = 0 then {value} else {name} end as {name}"
        for name, (n, value) in beyond.items()
    )
    planted = f"planted as (select * replace ({replaced}) from raw_sales)"
    rows = [_violations(c, f"length <= {n}", f"length({c}) > {n}") for c, n in lengths.items()]
    rows.append(
        _violations(
            "purchase_location_code",
            "length <= 2",
            "length(purchase_location_code) > 2 and purchase_location_code <> 'n/a'",
        )
    )
    rows += [_violations(c, "fits int", f"{c} not between -2147483648 and 2147483647") for c in ints]
    rows += [
        _violations(c, "fits decimal(10,7)", f"round(abs({c}), 7) >= 1000") for c in coordinates
    ]
    return f"with {RAW}, {planted}, {wide}\n" + "\nunion all\n".join(rows)


def oracle_sql() -> dict[str, str]:
    def converted(*names: str) -> str:
        columns = ", ".join(f"{CONVERTED[name][1]} as {name}" for name in names)
        return _from_raw(f"select {KEYS}, {columns} from raw_sales")

    staging = _from_staging(f"select {STAGED} from stg")
    fact = _from_warehouse(f"select {MEASURES} from fato")
    sks = ("produto", "vendedor", "local", "tempo", "pagamento")
    oracles = {name: _from_warehouse(select) for name, select in MARTS.items()}
    oracles |= {f"stored_{name}": oracles[name] for name in MARTS}
    oracles |= {
        "src_json_records": _from_raw(f"select {RENAMED} from raw_sales"),
        "src_json_list": _from_raw(f"select {RENAMED} from raw_sales"),
        "raw_scan_filter_project_sort_limit": _from_raw(
            f"""select {KEYS}, raw_produto as produto, raw_preco as preco,
  raw_vendedor as vendedor
from raw_sales where raw_pagamento = '1-URGENT' and raw_parcelas = '1'
order by l_orderkey desc, l_linenumber desc, l_partkey desc, l_suppkey desc limit 100"""
        ),
        "t_select_rename": _from_raw(f"select {KEYS}, {RENAMED} from raw_sales"),
        "t_product_id": _from_raw(f"select {KEYS}, {PRODUCT_ID} as product_id from raw_sales"),
        "t_normalize_text": _from_raw(f"select {KEYS}, {NORMALIZED} from raw_sales"),
        "t_price_cents": converted("price_cents"),
        "t_shipping_cents": converted("shipping_cost_cents"),
        "t_rating_int": converted("purchase_rating"),
        "t_installments_int": converted("installments_quantity"),
        "t_geo_decimal": converted("latitude", "longitude"),
        "t_parse_date": converted("purchase_date"),
        "t_defaults": _from_raw(
            f"select {KEYS}, {DEFAULTED}, cast(null as int) as price_cents, "
            "cast(null as date) as purchase_date from raw_sales"
        ),
        "t_load_timestamp": _from_raw(
            "select count(*) as stamped_rows, cast(0 as bigint) as unstamped_rows, "
            "true as one_timestamp from raw_sales"
        ),
        "staging_full": staging,
        "staging_load": staging,
        "staging_from_json": staging,
        "fato_vendas": fact,
        "fato_vendas_from_json": fact,
        "fato_vendas_append_twice": _from_warehouse(
            f"select {MEASURES} from fato union all select {MEASURES} from fato"
        ),
        "fato_vendas_two_collections": fact,
        "dq_rejects": _from_raw(
            "\nunion all\n".join(
                f"select '{name}' as field, count(*) filter (where {_rejected(name)}) as rejects "
                "from raw_sales"
                for name in CONVERTED
            )
        ),
        "dq_rejected_values": _from_raw(
            "\nunion all\n".join(
                f"select '{name}' as field, {raw} as value, "
                f"coalesce({PRODUCT_ID}, raw_produto) as product "
                f"from raw_sales where {_rejected(name)}"
                for name, (raw, _) in CONVERTED.items()
            )
        ),
        "dq_stage_counts": _from_warehouse(
            "\nunion all\n".join(
                f"select '{stage}' as stage, count(*) as rows from {relation}"
                for stage, relation in {
                    "raw": "raw_sales",
                    "staging": "stg",
                    **{f"dim_{name}": f"dim_{name}" for name in DIMENSIONS},
                    "fato": "fato",
                }.items()
            )
        ),
        "dq_duplicate_members": _from_warehouse(
            "\nunion all\n".join(
                f"select 'dim_{name}' as dimension, count(*) as duplicated_keys from "
                f"(select 1 from (select * from dim_{name} union all "
                f"select * from dim_{name} where sk_{name} % 3 = 0) m group by {spec['order'].replace(' nulls last', '')} "
                "having count(*) > 1) t"
                for name, spec in DIMENSIONS.items()
            )
        ),
        "dq_null_violations": _from_warehouse(
            "\nunion all\n".join(
                _nulls(table, column) for table, columns in REQUIRED.items() for column in columns
            )
        ),
        "dq_fk_orphans": _from_warehouse(
            "\nunion all\n".join(
                f"select 'sk_{name}' as fact_key, count(*) as orphan_rows from fato f "
                f"where not exists (select 1 from dim_{name} d where d.sk_{name} = f.sk_{name})"
                for name in sks
            )
        ),
        "dq_unmatched_sales": _from_warehouse(
            "\nunion all\n".join(
                f"select 'sk_{name}' as fact_key, count(*) as orphan_rows from stg s "
                f"where purchase_date is not null and not exists "
                f"(select 1 from dim_{name} d where {DIMENSIONS[name]['match']})"
                for name in sks
            )
        ),
        "dq_domain_violations": _domain_oracle(),
    }
    for name, spec in DIMENSIONS.items():
        columns = f"sk_{name}, {spec['columns']}"
        oracles[f"dim_{name}"] = _from_staging("").rstrip() + (
            f", {_dimension(name)}\nselect * from dim_{name}"
        )
        oracles[f"dim_incremental_{name}"] = _from_staging("").rstrip() + (
            f", {_dimension_in_two(name)}\nselect {columns} from both_batches"
        )
    return oracles
