"""Policies, claims, rates and dimensions derived from the order tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import AMOUNT, RATE
from ..operators.cohort import COSTS, MEASURES
from ..operators.merge import current_state

EVENT_COLUMNS = ["policy_id", "client_id", "product_id", "agency_id", "country", "channel", "issued_on", "cover_start", "cover_end", "premium", "currency", "status", "op", "updated_on"]


@dataclass
class Portfolio:
    """Views of one data folder; each is built on first use and lazy."""

    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def policy_base(self) -> DataFrame:
        nation = F.broadcast(self.table("nation").select("n_nationkey", "n_name", "n_regionkey"))  # a fixed table of countries
        customers = self.table("customer").select("c_custkey", "c_nationkey").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        o = self.table("orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
        issued = F.to_date("o_orderdate")
        currency = F.element_at(F.array(*map(F.lit, ["USD", "ARS", "BRL", "CLP"])), F.col("n_regionkey").cast("int") + 1)
        return o.select(
            F.col("o_orderkey").alias("policy_id"), F.col("o_custkey").alias("client_id"), (F.col("o_orderkey") % 301).alias("product_id"), (F.col("o_custkey") % 131).alias("agency_id"),
            F.col("n_name").alias("country"), F.col("o_orderpriority").alias("channel"), issued.alias("issued_on"), F.date_add(issued, 30).alias("cover_end"),
            F.col("o_totalprice").cast(AMOUNT).alias("premium"), F.when(F.col("n_regionkey") < 4, currency).otherwise("MXN").alias("currency"), F.col("o_orderstatus").alias("src_status"),
        )

    @cached_property
    def history(self) -> DataFrame:
        """Policy events: an insert each, an update for a quarter, a delete for a twentieth; one scan."""
        day = lambda n: F.date_add("issued_on", n)
        updated = F.when(F.col("src_status") == "F", "ANULADA").when(F.col("src_status") == "P", "VENCIDA").otherwise("EMITIDA")
        event = lambda op, status, premium, at: F.struct(F.lit(op).alias("op"), status.alias("status"), premium.cast(AMOUNT).alias("premium"), at.alias("updated_on"))
        insert = event("I", F.lit("EMITIDA"), F.col("premium"), F.col("issued_on"))
        update = F.when(F.col("policy_id") % 4 == 1, event("U", updated, F.col("premium") + 10, day(1)))
        delete = F.when((F.col("policy_id") % 40).isin(1, 3), event("D", F.lit("EMITIDA"), F.col("premium"), day(2)))
        df = self.policy_base.withColumn("e", F.explode(F.array_compact(F.array(insert, update, delete))))
        return df.withColumns({"cover_start": F.col("issued_on"), "premium": F.col("e.premium"), "status": F.col("e.status"), "op": F.col("e.op"), "updated_on": F.col("e.updated_on")}).select(*EVENT_COLUMNS)

    @cached_property
    def active(self) -> DataFrame:
        return current_state(self.history)

    @cached_property
    def claims(self) -> DataFrame:
        l = self.table("lineitem").join(self.policy_base.select("policy_id", F.col("currency").alias("_ccy")), F.col("l_orderkey") == F.col("policy_id")).drop("policy_id")
        status = F.when(F.col("l_returnflag") == "R", "PAGADO").when(F.col("l_returnflag") == "A", "RECHAZADO").otherwise("EN_ANALISIS")
        negative = (F.col("l_linenumber") == 7) & (F.col("l_partkey") % 10 == 0)
        return l.select(
            F.concat_ws("-", *(F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))).alias("claim_id"),
            F.when(F.col("l_partkey") % 97 == 0, F.col("l_orderkey") + 1000000000).otherwise(F.col("l_orderkey")).alias("policy_id"), F.to_date("l_shipdate").alias("occurred_on"),
            status.alias("status"), F.when(negative, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).cast(AMOUNT).alias("amount"),
            F.when(F.col("l_partkey") % 50 != 0, F.col("_ccy")).alias("currency"),
        )

    @cached_property
    def fx(self) -> DataFrame:
        """Monthly rates from 1996 on, some of them not positive: months times currencies, whatever the orders' number."""
        b = self.policy_base.where((F.col("currency") != "USD") & (F.col("issued_on") >= F.lit("1996-01-01").cast("date")))
        g = b.groupBy(F.trunc("issued_on", "MM").alias("rate_date"), "currency").agg(F.count(F.lit(1)).alias("n"))
        factor = F.when(F.col("n") % 10 == 0, F.lit("-1").cast(RATE)).otherwise(((50 + F.col("n") % 100).cast("decimal(18,9)") / 100).cast(RATE))
        return g.select("rate_date", "currency", factor.alias("factor_usd"))

    @cached_property
    def products(self) -> DataFrame:
        p = self.table("part")
        return p.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("plan_name"), F.col("p_type").alias("product_type"), F.col("p_retailprice").cast(AMOUNT).alias("max_cover_usd"), (F.col("p_size") > 25).alias("is_premium"))

    @cached_property
    def agencies(self) -> DataFrame:
        channel = F.element_at(F.array(*map(F.lit, ["ONLINE", "CALL_CENTER", "PARTNER", "RETAIL"])), (F.col("s_suppkey") % 4).cast("int") + 1)
        return self.table("supplier").select(F.col("s_suppkey").alias("agency_id"), F.col("s_name").alias("name"), channel.alias("channel"))


#: The same views as common table expressions for the oracle.
CTE = """
policy_base AS (
  SELECT o.o_orderkey AS policy_id, o.o_custkey AS client_id, o.o_orderkey % 301 AS product_id, o.o_custkey % 131 AS agency_id, n.n_name AS country,
    o.o_orderpriority AS channel, CAST(o.o_orderdate AS DATE) AS issued_on, CAST(CAST(o.o_orderdate AS DATE) + INTERVAL '30' DAY AS DATE) AS cover_end,
    CAST(o.o_totalprice AS DECIMAL(19,9)) AS premium,
    CASE n.n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'ARS' WHEN 2 THEN 'BRL' WHEN 3 THEN 'CLP' ELSE 'MXN' END AS currency, o.o_orderstatus AS src_status
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey),
history AS (
  SELECT policy_id, client_id, product_id, agency_id, country, channel, issued_on, issued_on AS cover_start, cover_end, premium, currency, 'EMITIDA' AS status, 'I' AS op, issued_on AS updated_on FROM policy_base
  UNION ALL
  SELECT policy_id, client_id, product_id, agency_id, country, channel, issued_on, issued_on, cover_end, CAST(premium + 10 AS DECIMAL(19,9)), currency,
    CASE src_status WHEN 'F' THEN 'ANULADA' WHEN 'P' THEN 'VENCIDA' ELSE 'EMITIDA' END, 'U', CAST(issued_on + INTERVAL '1' DAY AS DATE) FROM policy_base WHERE policy_id % 4 = 1
  UNION ALL
  SELECT policy_id, client_id, product_id, agency_id, country, channel, issued_on, issued_on, cover_end, premium, currency, 'EMITIDA', 'D', CAST(issued_on + INTERVAL '2' DAY AS DATE)
  FROM policy_base WHERE policy_id % 40 IN (1, 3)),
latest AS (SELECT * EXCLUDE (rn) FROM (SELECT h.*, ROW_NUMBER() OVER (PARTITION BY policy_id ORDER BY updated_on DESC) AS rn FROM history h) x WHERE rn = 1),
active AS (SELECT * FROM latest WHERE op <> 'D'),
claims AS (
  SELECT concat(CAST(l.l_orderkey AS VARCHAR), '-', CAST(l.l_linenumber AS VARCHAR), '-', CAST(l.l_partkey AS VARCHAR), '-', CAST(l.l_suppkey AS VARCHAR)) AS claim_id,
    CASE WHEN l.l_partkey % 97 = 0 THEN l.l_orderkey + 1000000000 ELSE l.l_orderkey END AS policy_id, CAST(l.l_shipdate AS DATE) AS occurred_on,
    CASE l.l_returnflag WHEN 'R' THEN 'PAGADO' WHEN 'A' THEN 'RECHAZADO' ELSE 'EN_ANALISIS' END AS status,
    CAST(CASE WHEN l.l_linenumber = 7 AND l.l_partkey % 10 = 0 THEN -l.l_extendedprice ELSE l.l_extendedprice END AS DECIMAL(19,9)) AS amount,
    CASE WHEN l.l_partkey % 50 = 0 THEN NULL ELSE b.currency END AS currency
  FROM lineitem l JOIN policy_base b ON b.policy_id = l.l_orderkey),
fx AS (
  SELECT rate_date, currency, CAST(CASE WHEN n % 10 = 0 THEN -1.00 ELSE CAST(50 + n % 100 AS DECIMAL(18,9)) / 100 END AS DECIMAL(18,9)) AS factor_usd
  FROM (SELECT CAST(DATE_TRUNC('month', issued_on) AS DATE) AS rate_date, currency, COUNT(*) AS n FROM policy_base WHERE currency <> 'USD' AND issued_on >= DATE '1996-01-01' GROUP BY 1, 2) g),
products AS (SELECT p_partkey AS product_id, p_name AS plan_name, p_type AS product_type, CAST(p_retailprice AS DECIMAL(19,9)) AS max_cover_usd, p_size > 25 AS is_premium FROM part),
agencies AS (SELECT s_suppkey AS agency_id, s_name AS name, CASE s_suppkey % 4 WHEN 0 THEN 'ONLINE' WHEN 1 THEN 'CALL_CENTER' WHEN 2 THEN 'PARTNER' ELSE 'RETAIL' END AS channel FROM supplier)"""

RATES_CTE = CTE + """,
rates AS (SELECT currency, rate_date, factor_usd, LEAD(rate_date, 1, DATE '9999-12-31') OVER (PARTITION BY currency ORDER BY rate_date) AS next_date FROM fx WHERE factor_usd > 0)"""

FLAGS_CTE = RATES_CTE + """,
policy_ccy AS (SELECT policy_id, CASE WHEN COUNT(DISTINCT UPPER(TRIM(currency))) = 1 THEN MAX(UPPER(TRIM(currency))) END AS ccy FROM history GROUP BY 1),
cover AS (SELECT c.claim_id, c.policy_id, COUNT(DISTINCT (h.cover_start, h.cover_end)) FILTER (h.op <> 'D' AND c.occurred_on BETWEEN h.cover_start AND h.cover_end) AS n, COUNT(h.policy_id) AS events
          FROM claims c LEFT JOIN history h ON h.policy_id = c.policy_id GROUP BY 1, 2),
flagged0 AS (
  SELECT c.*, CASE WHEN v.events = 0 THEN 'POLIZA_AUSENTE' WHEN v.n = 0 THEN 'FUERA_PERIODO' WHEN v.n = 1 THEN 'COINCIDE' ELSE 'COBERTURA_AMBIGUA' END AS cover_state,
    COALESCE(NULLIF(UPPER(TRIM(c.currency)), ''), p.ccy) AS claim_currency,
    CASE WHEN NULLIF(UPPER(TRIM(c.currency)), '') IS NOT NULL THEN 'FUENTE' WHEN p.ccy IS NOT NULL THEN 'INFERIDA_POLIZA' ELSE 'NO_DISPONIBLE' END AS currency_origin
  FROM claims c JOIN cover v ON v.claim_id = c.claim_id LEFT JOIN policy_ccy p ON p.policy_id = c.policy_id),
flagged1 AS (SELECT f.*, COALESCE(f.claim_currency = 'USD', FALSE) OR EXISTS (SELECT 1 FROM fx r WHERE r.currency = f.claim_currency AND r.factor_usd > 0 AND r.rate_date <= f.occurred_on) AS has_rate FROM flagged0 f),
flagged AS (
  SELECT * EXCLUDE (has_rate),
    CASE WHEN amount IS NULL THEN 'MONTO_NULO' WHEN amount < 0 AND currency IS NULL THEN 'MONTO_NEGATIVO_Y_MONEDA_NULA' WHEN amount < 0 THEN 'MONTO_NEGATIVO' WHEN claim_currency IS NULL THEN 'MONEDA_NO_RECUPERABLE'
         WHEN NOT has_rate THEN 'SIN_COTIZACION' WHEN currency_origin = 'INFERIDA_POLIZA' THEN 'VALIDO_MONEDA_INFERIDA' ELSE 'VALIDO' END AS amount_state,
    amount IS NULL OR amount < 0 OR claim_currency IS NULL OR NOT has_rate AS excluded
  FROM flagged1)"""

CUTOFF, FIRST, LAST = "2000-12-31", "1997-01-01", "1997-06-30"

MART_CTE = FLAGS_CTE + f""",
scoped AS (
  SELECT f.*, CASE WHEN a.policy_id IS NULL THEN 'POLIZA_D_O_AUSENTE' WHEN UPPER(TRIM(COALESCE(a.status, ''))) = 'ANULADA' THEN 'POLIZA_ANULADA' WHEN a.issued_on > DATE '{CUTOFF}' THEN 'EMISION_FUTURA'
         WHEN f.occurred_on > DATE '{CUTOFF}' THEN 'OCURRENCIA_FUTURA' ELSE 'INCLUIDO' END AS scope
  FROM flagged f LEFT JOIN active a ON a.policy_id = f.policy_id),
claim_values AS (
  SELECT s.*, CASE WHEN NOT excluded THEN CAST(s.amount * CAST(CASE WHEN s.claim_currency = 'USD' THEN 1 ELSE r.factor_usd END AS DECIMAL(18,9)) AS DECIMAL(38,9)) END AS cost_usd
  FROM scoped s LEFT JOIN rates r ON r.currency = s.claim_currency AND s.occurred_on >= r.rate_date AND s.occurred_on < r.next_date WHERE s.scope = 'INCLUIDO'),
policy_values AS (
  SELECT a.*, COALESCE(a.country, 'DESCONOCIDO') AS pais, COALESCE(p.plan_name, 'DESCONOCIDO') AS producto, COALESCE(p.product_type, 'DESCONOCIDO') AS tipo_producto, p.is_premium AS es_premium,
    COALESCE(g.channel, 'DESCONOCIDO') AS canal_agencia, COALESCE(a.channel, 'DESCONOCIDO') AS canal_origen,
    CASE WHEN a.premium >= 0 THEN CAST(a.premium * CAST(CASE WHEN UPPER(TRIM(a.currency)) = 'USD' THEN 1 ELSE r.factor_usd END AS DECIMAL(18,9)) AS DECIMAL(38,9)) END AS premium_usd
  FROM active a LEFT JOIN products p ON p.product_id = a.product_id LEFT JOIN agencies g ON g.agency_id = a.agency_id
  LEFT JOIN rates r ON r.currency = UPPER(TRIM(a.currency)) AND a.issued_on >= r.rate_date AND a.issued_on < r.next_date
  WHERE UPPER(TRIM(COALESCE(a.status, ''))) <> 'ANULADA' AND a.issued_on <= DATE '{CUTOFF}'),
by_policy AS (
  SELECT policy_id, COUNT(*) FILTER (NOT excluded) AS siniestros, COUNT(*) FILTER (NOT excluded AND status = 'PAGADO') AS siniestros_pagados,
    COUNT(*) FILTER (NOT excluded AND status = 'RECHAZADO') AS siniestros_rechazados, COUNT(*) FILTER (NOT excluded AND status = 'EN_ANALISIS') AS siniestros_en_analisis,
    COUNT(*) FILTER (NOT excluded AND (status IS NULL OR status NOT IN ('PAGADO', 'RECHAZADO', 'EN_ANALISIS'))) AS siniestros_otros_estados,
    COUNT(*) FILTER (status = 'PAGADO' AND cost_usd IS NOT NULL) AS siniestros_pagados_con_costo_usd, COALESCE(SUM(cost_usd) FILTER (status = 'PAGADO'), 0) AS costo_pagado_usd,
    CAST(0 AS BIGINT) AS siniestros_sin_poliza, COUNT(*) FILTER (NOT excluded AND cover_state <> 'COINCIDE') AS siniestros_sin_periodo,
    COUNT(*) FILTER (NOT excluded AND status = 'PAGADO' AND cover_state <> 'COINCIDE') AS siniestros_pagados_sin_periodo,
    COALESCE(SUM(cost_usd) FILTER (status = 'PAGADO' AND cover_state <> 'COINCIDE'), 0) AS costo_pagado_sin_periodo_usd, CAST(0 AS BIGINT) AS siniestros_poliza_anulada, CAST(0 AS BIGINT) AS siniestros_poliza_borrada,
    COUNT(*) FILTER (NOT excluded AND status = 'PAGADO' AND cover_state = 'COINCIDE') AS siniestros_pagados_con_periodo,
    COUNT(*) FILTER (status = 'PAGADO' AND cover_state = 'COINCIDE' AND cost_usd IS NOT NULL) AS siniestros_pagados_con_periodo_con_costo_usd,
    COALESCE(SUM(cost_usd) FILTER (status = 'PAGADO' AND cover_state = 'COINCIDE'), 0) AS costo_pagado_con_periodo_usd, COUNT(*) FILTER (excluded) AS siniestros_excluidos,
    COUNT(*) FILTER (excluded AND status = 'PAGADO') AS siniestros_pagados_excluidos, COUNT(*) FILTER (NOT excluded AND currency_origin = 'INFERIDA_POLIZA') AS siniestros_moneda_inferida,
    COUNT(*) FILTER (NOT excluded AND status = 'PAGADO' AND currency_origin = 'INFERIDA_POLIZA') AS siniestros_pagados_moneda_inferida
  FROM claim_values GROUP BY 1)"""

_ZERO_FILLED = ", ".join(f"COALESCE(b.{m}, 0) AS {m}" for m in MEASURES)
_SUMS = ", ".join(f"SUM({m}) AS {m}" if m in COSTS else f"CAST(SUM({m}) AS BIGINT) AS {m}" for m in MEASURES)

#: ``detail`` and ``mart`` as well.
FULL_CTE = MART_CTE + f""",
detail AS (SELECT p.*, {_ZERO_FILLED} FROM policy_values p LEFT JOIN by_policy b ON b.policy_id = p.policy_id),
mart AS (
  SELECT CAST(DATE_TRUNC('month', issued_on) AS DATE) AS "date", CAST(YEAR(issued_on) AS BIGINT) AS "year", CAST(MONTH(issued_on) AS BIGINT) AS "month", CAST(1 AS BIGINT) AS "day", strftime(issued_on, '%Y-%m') AS year_month,
    CAST(YEAR(issued_on) AS VARCHAR) || '-Q' || CAST(QUARTER(issued_on) AS VARCHAR) AS year_quarter, CAST(YEAR(issued_on) AS VARCHAR) || '-S' || CASE WHEN MONTH(issued_on) <= 6 THEN '1' ELSE '2' END AS year_semester,
    ['domingo', 'lunes', 'martes', 'miércoles', 'jueves', 'viernes', 'sábado'][CAST(dayofweek(DATE_TRUNC('month', issued_on)) AS INT) + 1] AS day_of_week,
    pais, producto, es_premium, canal_origen, tipo_producto, canal_agencia, COUNT(*) AS polizas, COUNT(premium_usd) AS polizas_con_prima_usd, COALESCE(SUM(premium_usd), 0) AS prima_usd, {_SUMS}
  FROM detail GROUP BY ALL)"""
