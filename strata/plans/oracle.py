"""The same results in DuckDB SQL, built from shared WITH fragments."""

from __future__ import annotations

UNITS = "CAST(4611686018427387904 AS DOUBLE)"


def exact(value: str) -> str:
    """Sum of raw doubles in units of 2**-62, which whole 128-bit numbers add without rounding."""
    total = f"sum(CAST({value} * {UNITS} AS HUGEINT))"
    return f"(CAST({total} // 4611686018427387904 AS DOUBLE) + CAST(CAST({total} % 4611686018427387904 AS BIGINT) AS DOUBLE) / {UNITS})"


# Named fragments and what each of them needs.
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "sites": (
        (),
        """SELECT s_suppkey AS site_id, s_name AS site_name, n_name AS location,
             r_name AS primary_mineral,
             CASE s_suppkey % 3 WHEN 0 THEN 'Open Pit' WHEN 1 THEN 'Underground'
                  ELSE 'Surface' END AS mining_method,
             CASE WHEN s_acctbal < 0 THEN 'Maintenance' ELSE 'Active' END AS status
           FROM supplier JOIN nation ON s_nationkey = n_nationkey
                         JOIN region ON n_regionkey = r_regionkey""",
    ),
    "production": (
        (),
        """SELECT l_suppkey AS site_id, l_shipdate AS production_datetime,
             CAST(l_shipdate AS DATE) AS production_date,
             CAST(l_quantity AS INTEGER) AS tons_extracted,
             l_discount * 100 AS mineral_grade_percent,
             CAST(1 AS DOUBLE) AS operating_hours,
             l_extendedprice / NULLIF(l_quantity, 0) AS cost_per_ton_usd,
             l_extendedprice AS total_cost_usd
           FROM lineitem""",
    ),
    "equipment": (
        (),
        """SELECT o_custkey AS equipment_id,
             o_custkey % (SELECT count(*) FROM supplier) AS site_id,
             'EQ-' || o_custkey AS equipment_name, o_orderpriority AS equipment_type,
             o_orderstatus AS category,
             CAST(o_orderkey % 15000 AS INTEGER) AS operating_hours,
             CAST(o_orderdate AS DATE) AS last_maintenance_date,
             CAST(o_orderdate AS DATE) + CAST(30 + o_orderkey % 91 AS INTEGER) AS next_maintenance_date,
             CAST(60 + o_orderkey % 39 AS INTEGER) AS health_score,
             CASE WHEN 60 + o_orderkey % 39 < 70 THEN 'Needs Attention'
                  WHEN 60 + o_orderkey % 39 < 80 THEN 'Monitor' ELSE 'Operational' END AS status,
             o_totalprice AS annual_maintenance_cost_usd, o_orderkey AS event_id
           FROM orders""",
    ),
    "versions": (
        ("equipment",),
        """SELECT * FROM equipment QUALIFY row_number() OVER (
             PARTITION BY equipment_id, site_id, last_maintenance_date ORDER BY event_id DESC) = 1""",
    ),
    "history": (
        ("versions",),
        """SELECT *, last_maintenance_date AS "__START_AT",
             lead(last_maintenance_date) OVER (PARTITION BY equipment_id, site_id
               ORDER BY last_maintenance_date) AS "__END_AT" FROM versions""",
    ),
    "fleet": (("history",), 'SELECT * EXCLUDE ("__START_AT", "__END_AT") FROM history WHERE "__END_AT" IS NULL'),
    "risk": (
        ("fleet", "sites"),
        """SELECT equipment_id, equipment_name, equipment_type, f.site_id, site_name, location,
             s.status AS site_status, health_score, f.status, operating_hours,
             next_maintenance_date, annual_maintenance_cost_usd
           FROM fleet f LEFT JOIN sites s ON f.site_id = s.site_id""",
    ),
    "daily": (
        ("production",),
        f"""SELECT site_id, production_date, CAST(sum(tons_extracted) AS BIGINT) AS total_tons,
             {exact("mineral_grade_percent")} / count(mineral_grade_percent) AS avg_grade,
             {exact("total_cost_usd")} AS total_cost,
             count(*) AS record_count
           FROM production GROUP BY site_id, production_date""",
    ),
    "targets": (
        (),
        """SELECT s_suppkey AS site_id, s_name AS site_name,
             CAST(120 + 20 * (s_suppkey % 8) AS INTEGER) AS monthly_target_tons FROM supplier""",
    ),
    "versus": (
        ("daily", "targets"),
        """SELECT site_id, site_name, month, actual_tons, monthly_target_tons,
             actual_tons - monthly_target_tons AS delta_tons,
             actual_tons * CAST(100 AS DOUBLE) / monthly_target_tons AS pct_of_target
           FROM (SELECT site_id, CAST(date_trunc('month', production_date) AS DATE) AS month,
                   CAST(sum(total_tons) AS BIGINT) AS actual_tons FROM daily
                 WHERE production_date BETWEEN DATE '2001-06-15' - 90 AND DATE '2001-06-15'
                 GROUP BY 1, 2) JOIN targets USING (site_id)""",
    ),
    "source": (
        (),
        """SELECT o_orderkey AS order_id, o_custkey AS site_id,
             CAST(o_orderdate AS DATE) AS production_date, o_orderpriority AS priority,
             CAST(trunc(o_totalprice / 1000) AS INTEGER) AS tons_extracted,
             CAST(25 AS DOUBLE) + o_orderkey % 30 AS cost_per_ton_usd,
             o_totalprice AS total_cost_usd FROM orders""",
    ),
    "book0": (("source",), "SELECT * FROM source WHERE production_date <= DATE '2000-06-30'"),
    "book1": (
        ("source",),
        """SELECT * REPLACE (CASE WHEN priority = '1-URGENT' THEN total_cost_usd * 2
             ELSE total_cost_usd END AS total_cost_usd) FROM source
           WHERE production_date BETWEEN DATE '1995-07-01' AND DATE '2000-12-31'""",
    ),
    "book2": (
        ("source",),
        """SELECT * REPLACE (CASE WHEN priority IN ('1-URGENT', '5-LOW') THEN total_cost_usd * 2
             ELSE total_cost_usd END AS total_cost_usd) FROM source
           WHERE production_date >= DATE '1996-01-01' OR production_date IS NULL""",
    ),
}


def _feed(old: str, new: str, version: int, month: int) -> str:
    same = "n.total_cost_usd = o.total_cost_usd"
    stamp = f"CAST({version} AS BIGINT) AS _commit_version, TIMESTAMP '2001-{month:02d}-01' AS _commit_timestamp"
    return f"""
      SELECT n.*, 'insert' AS _change_type, {stamp} FROM {new} n ANTI JOIN {old} o USING (order_id)
      UNION ALL SELECT o.*, 'delete', {stamp} FROM {old} o ANTI JOIN {new} n USING (order_id)
      UNION ALL SELECT o.*, 'update_preimage', {stamp}
        FROM {old} o JOIN {new} n ON o.order_id = n.order_id WHERE NOT ({same})
      UNION ALL SELECT n.*, 'update_postimage', {stamp}
        FROM {old} o JOIN {new} n ON o.order_id = n.order_id WHERE NOT ({same})"""


PARTS["feed1"] = (("book0", "book1"), _feed("book0", "book1", 1, 2))
PARTS["feed2"] = (("book1", "book2"), _feed("book1", "book2", 2, 3))
PARTS["feeds"] = (("feed1", "feed2"), "SELECT * FROM feed1 UNION ALL SELECT * FROM feed2")
PARTS["net"] = (
    ("feeds",),
    """SELECT * FROM feeds WHERE _change_type <> 'update_preimage'
       QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _commit_version DESC) = 1""",
)
PARTS["audit"] = (
    ("book0", "feeds"),
    """SELECT *, 'INSERT' AS _operation, CAST(0 AS BIGINT) AS _commit_version,
         TIMESTAMP '2001-01-01' AS _commit_timestamp FROM book0
       UNION ALL SELECT * EXCLUDE (_change_type, _commit_version, _commit_timestamp),
         upper(_change_type), _commit_version, _commit_timestamp
       FROM feeds WHERE _change_type IN ('insert', 'update_postimage')""",
)
PARTS["words"] = (
    (),
    r"""SELECT doc_id AS path,
          list_filter(string_split_regex(text, '\s+'), lambda w: w <> '') AS w FROM documents""",
)
PARTS["chunks"] = (
    ("words",),
    """SELECT sha256(length(path::VARCHAR) || ':' || path || length(position::VARCHAR) || ':' || position) AS chunk_id, path, CAST(position AS INTEGER) AS position,
         array_to_string(w[position * 400 + 1 : position * 400 + 500], ' ') AS content
       FROM (SELECT path, w, unnest(range(0, CAST(ceil(greatest(len(w) - 500, 0) / 400.0) AS BIGINT) + 1))
               AS position FROM words WHERE len(w) > 0)""",
)


def build(*needs: str, body: str) -> str:
    """``body`` with the fragments it needs, each once and in order."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for dep in PARTS[name][0]:
                add(dep)
            order.append(name)

    for name in needs:
        add(name)
    clauses = ", ".join(f"{n} AS ({PARTS[n][1]})" for n in order)
    return f"WITH {clauses} {body}" if order else body


def plain(name: str) -> str:
    return build(name, body=f"SELECT * FROM {name}")


LAST_30 = "production_date BETWEEN DATE '2001-06-15' - 30 AND DATE '2001-06-15'"
LAST_90 = "production_date BETWEEN DATE '2001-06-15' - 90 AND DATE '2001-06-15'"
LAST_MONTH = "production_date >= DATE '2001-05-01' AND production_date < DATE '2001-06-01'"
GRADE = f"{exact('mineral_grade_percent')} / count(mineral_grade_percent)"
COST = exact("total_cost_usd")
TONS = "CAST(sum(tons_extracted) AS BIGINT)"
DUE = "next_maintenance_date <= DATE '2001-06-15'"
FLEET_TAIL = f"""CAST(count(e.equipment_id) AS BIGINT) AS total_equipment,
  CAST(coalesce(sum(CASE WHEN health_score < 70 OR {DUE} THEN 1 ELSE 0 END), 0) AS BIGINT) AS equipment_at_risk
  FROM sites s LEFT JOIN fleet e ON e.site_id = s.site_id"""

ORACLE: dict[str, str] = {
    # gold marts
    "production_by_site": build("production", "sites", body=f"""
      SELECT s.site_id, site_name, location, primary_mineral, mining_method, status AS site_status,
        production_date, {TONS} AS tons_extracted, {GRADE} AS avg_grade_percent,
        {COST} AS total_cost_usd, sum(operating_hours) AS operating_hours, count(*) AS record_count
      FROM production p JOIN sites s ON p.site_id = s.site_id GROUP BY 1, 2, 3, 4, 5, 6, 7"""),
    "production_by_mineral": build("production", "sites", body=f"""
      SELECT primary_mineral, production_date, count(DISTINCT s.site_id) AS site_count,
        {TONS} AS total_tons_extracted, {GRADE} AS avg_grade_percent, {COST} AS total_cost_usd,
        {COST} / NULLIF({TONS}, 0) AS avg_cost_per_ton_usd
      FROM production p JOIN sites s ON p.site_id = s.site_id GROUP BY 1, 2"""),
    "site_day_rollup": plain("daily"),
    "executive_daily": build("production", body=f"""
      SELECT production_date AS report_date, {TONS} AS total_tons_extracted,
        {COST} AS total_production_cost_usd, {COST} / NULLIF({TONS}, 0) AS blended_cost_per_ton_usd,
        count(DISTINCT site_id) AS sites_reporting_production
      FROM production GROUP BY 1"""),
    "site_performance": build("production", "sites", body=f"""
      SELECT s.site_id, site_name, location, primary_mineral, {TONS} AS tons_last_30d,
        {COST} AS cost_last_30d_usd, {COST} / NULLIF({TONS}, 0) AS cost_per_ton_30d_usd,
        {GRADE} AS avg_grade_percent_30d, rank() OVER (ORDER BY {TONS} DESC) AS tons_rank
      FROM production p JOIN sites s ON p.site_id = s.site_id WHERE {LAST_30} GROUP BY 1, 2, 3, 4"""),
    "equipment_health_by_site": build("fleet", "sites", body=f"""
      SELECT s.site_id, site_name, primary_mineral, count(*) AS equipment_count,
        count(*) FILTER (e.status = 'Operational') AS operational_count,
        count(*) FILTER (e.status = 'Needs Attention') AS needs_attention_count,
        count(*) FILTER (e.status = 'Monitor') AS monitor_count,
        CAST(sum(health_score) AS DOUBLE) / count(health_score) AS avg_health_score,
        {exact("annual_maintenance_cost_usd")}
          AS total_annual_maintenance_cost_usd,
        count(*) FILTER ({DUE}) AS maintenance_overdue_count
      FROM fleet e JOIN sites s ON e.site_id = s.site_id GROUP BY 1, 2, 3"""),
    "maintenance_due": build("fleet", "sites", body="""
      SELECT e.site_id, site_name, location, equipment_id, equipment_name, equipment_type,
        health_score, e.status, last_maintenance_date, next_maintenance_date,
        CAST(date_diff('day', DATE '2001-06-15', next_maintenance_date) AS INTEGER)
          AS days_until_maintenance, annual_maintenance_cost_usd
      FROM fleet e JOIN sites s ON e.site_id = s.site_id
      WHERE next_maintenance_date <= DATE '2001-06-15' + 30 OR health_score < 80"""),
    "fleet_snapshot": build("fleet", "sites", body=f"""
      SELECT count(DISTINCT s.site_id) AS total_sites,
        CAST(sum(CASE WHEN s.status = 'Active' THEN 1 ELSE 0 END) AS BIGINT) AS active_sites, {FLEET_TAIL}"""),
    "fleet_snapshot_distinct": build("fleet", "sites", body=f"""
      SELECT count(DISTINCT s.site_id) AS total_sites,
        count(DISTINCT CASE WHEN s.status = 'Active' THEN s.site_id END) AS active_sites, {FLEET_TAIL}"""),
    "equipment_risk": plain("risk"),
    # reports
    "tons_last_90d": build("daily", body=f"""SELECT production_date, CAST(sum(total_tons) AS BIGINT) AS tons
      FROM daily WHERE {LAST_90} GROUP BY 1"""),
    "tons_total_90d": build("daily", body=f"""SELECT CAST(coalesce(sum(total_tons), 0) AS BIGINT) AS tons
      FROM daily WHERE {LAST_90}"""),
    "top_sites": build("daily", body="""SELECT site_id, CAST(sum(total_tons) AS BIGINT) AS tons
      FROM daily GROUP BY 1 ORDER BY tons DESC, site_id LIMIT 10"""),
    "top_site_last_month": build("daily", body=f"""SELECT site_id, CAST(sum(total_tons) AS BIGINT) AS tons
      FROM daily WHERE {LAST_MONTH} GROUP BY 1 ORDER BY tons DESC, site_id LIMIT 1"""),
    "low_health": build("risk", body="SELECT * FROM risk WHERE health_score < 70"),
    "lowest_health": build("risk", body="""SELECT equipment_id, equipment_name, site_id, site_name, site_status,
      health_score, status FROM risk ORDER BY health_score, equipment_id, site_id LIMIT 15"""),
    "target_vs_actual": plain("versus"),
    "top_target_deltas": build("versus", body="SELECT * FROM versus ORDER BY delta_tons DESC, site_id, month LIMIT 20"),
    "missed_targets": build("daily", "targets", body=f"""
      SELECT t.site_id, site_name, coalesce(tons, 0) AS actual_tons, monthly_target_tons,
        coalesce(tons, 0) - monthly_target_tons AS delta_tons
      FROM targets t LEFT JOIN (SELECT site_id, CAST(sum(total_tons) AS BIGINT) AS tons FROM daily
        WHERE {LAST_MONTH} GROUP BY 1) a ON t.site_id = a.site_id
      WHERE coalesce(tons, 0) < monthly_target_tons"""),
    "site_extent": build("production", body="""SELECT site_id, count(*) AS daily_rows,
      min(production_date) AS earliest, max(production_date) AS latest FROM production GROUP BY 1"""),
    "partition_counts": build("production", body="""SELECT production_date, count(*) AS rows
      FROM production GROUP BY 1 ORDER BY 1 DESC LIMIT 10"""),
    # projections, functions
    "silver_passthrough": plain("production"),
    "silver_cleanse": build("production", body="""SELECT * FROM production
      WHERE tons_extracted >= 0 AND mineral_grade_percent BETWEEN 0 AND 5"""),
    "derive_cost": """SELECT l_orderkey, l_linenumber, l_partkey,
        l_extendedprice * (1 - l_discount) AS net_price,
        CAST(trunc(l_extendedprice * (1 - l_discount)) AS INTEGER) AS net_dollars,
        trunc(l_extendedprice * (1 - l_discount)) / l_quantity AS cost_per_ton FROM lineitem""",
    "health_band": build("equipment", body="SELECT event_id, health_score, status AS band FROM equipment"),
    "date_math": """SELECT o_orderkey AS order_id, d + 30 AS plus_30, d - 90 AS minus_90,
        CAST(d - INTERVAL 30 DAY AS DATE) AS minus_interval, CAST(date_trunc('month', d) AS DATE) AS month,
        CAST(date_diff('day', d, DATE '2001-06-15') AS INTEGER) AS age_days
      FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
    "time_spine": """SELECT h AS production_datetime, CAST(h AS DATE) AS production_date,
        CAST(hour(h) AS INTEGER) AS hour_of_day
      FROM (SELECT unnest(generate_series(CAST(min(l_shipdate)::DATE AS TIMESTAMP),
        CAST(max(l_shipdate)::DATE AS TIMESTAMP) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS h FROM lineitem)""",
    "slugify": """SELECT c_custkey, trim(regexp_replace(lower(c_name || ' - ' || c_mktsegment),
        '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM customer""",
    "json_path": """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        CAST(length(props) AS INTEGER) AS props_length FROM events""",
    "variant_path": """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    # quality
    "expect_fail": plain("equipment"),
    "expect_drop": build("equipment", body="""SELECT * FROM equipment
      WHERE equipment_id > 0 AND site_id IS NOT NULL AND health_score >= 70"""),
    "expect_metrics": build("equipment", body="""
      SELECT 'valid_equipment_id' AS rule, count(*) FILTER (NOT equipment_id > 0) AS violations,
        count(*) AS rows FROM equipment
      UNION ALL SELECT 'valid_site', count(*) FILTER (site_id IS NULL), count(*) FROM equipment
      UNION ALL SELECT 'healthy', count(*) FILTER (NOT health_score >= 70), count(*) FROM equipment"""),
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem
      GROUP BY 1, 2 HAVING count(*) > 1""",
    "reconcile_totals": build("daily", "production", body=f"""
      SELECT measure, gold_value, source_value, gold_value - source_value AS difference FROM (
        SELECT 'tons' AS measure, CAST((SELECT sum(total_tons) FROM daily) AS DOUBLE) AS gold_value,
          CAST((SELECT sum(tons_extracted) FROM production) AS DOUBLE) AS source_value
        UNION ALL SELECT 'cost', (SELECT {exact("total_cost")} FROM daily),
          (SELECT {exact("total_cost_usd")} FROM production)
        UNION ALL SELECT 'rows', CAST((SELECT sum(record_count) FROM daily) AS DOUBLE),
          CAST((SELECT count(*) FROM production) AS DOUBLE))"""),
    "ghost_rows": build("book0", "book1", body="""SELECT * FROM book0 g
      WHERE NOT EXISTS (SELECT 1 FROM book1 s WHERE s.order_id = g.order_id)"""),
    "batch_inventory": build("audit", body="""SELECT _commit_version, count(*) AS rows,
      max(_commit_timestamp) AS loaded_at FROM audit GROUP BY 1"""),
    # joins
    "missing_site_days": build("production", body="""
      SELECT s_suppkey AS site_id, d AS production_date FROM supplier, (
        SELECT CAST(unnest(generate_series(CAST(min(production_date) AS TIMESTAMP),
          CAST(max(production_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM production)
      WHERE NOT EXISTS (SELECT 1 FROM production p WHERE p.site_id = s_suppkey AND p.production_date = d)"""),
    "lookup_join": f"""SELECT p_brand, count(*) AS readings,
        {exact("p_retailprice")} AS list_price
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
    "semi_keys": build("book0", "feed1", body="""SELECT * FROM book0 WHERE order_id IN
      (SELECT order_id FROM feed1 WHERE _change_type = 'delete')"""),
    "anti_keys": build("book1", body="""SELECT c_custkey, c_name FROM customer
      WHERE c_custkey NOT IN (SELECT site_id FROM book1)"""),
    "peer_access": """SELECT s_suppkey, (SELECT count(*) FROM supplier) - 1 AS readers FROM supplier""",
    # windows, changes, history
    "latest_per_key": plain("fleet"),
    "audit_latest": build("audit", body="""SELECT * FROM audit QUALIFY row_number() OVER (
      PARTITION BY order_id ORDER BY _commit_version DESC) = 1"""),
    "scd2_history": plain("history"),
    "scd2_subset": build("versions", body="""
      SELECT *, last_maintenance_date AS "__START_AT", lead(last_maintenance_date) OVER (
          PARTITION BY equipment_id, site_id ORDER BY last_maintenance_date) AS "__END_AT"
      FROM (SELECT equipment_id, site_id, last_maintenance_date, status FROM versions
        QUALIFY lag(status) OVER (PARTITION BY equipment_id, site_id ORDER BY last_maintenance_date)
          IS DISTINCT FROM status)"""),
    "scd2_timestamps": """
      SELECT *, ts AS "__START_AT", lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS "__END_AT"
      FROM (SELECT user_id, ts, event_type FROM (
              SELECT * FROM events QUALIFY row_number() OVER (
                PARTITION BY user_id, ts ORDER BY event_id DESC) = 1)
        QUALIFY lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) IS DISTINCT FROM event_type)""",
    "scd2_current": build("history", body='SELECT * FROM history WHERE "__END_AT" IS NULL'),
    "scd2_as_of": build("history", body="""SELECT * FROM history WHERE "__START_AT" <= DATE '1999-01-01'
      AND ("__END_AT" IS NULL OR "__END_AT" > DATE '1999-01-01')"""),
    "scd2_apply": plain("history"),
    "change_feed": plain("feed1"),
    "change_breakdown": build("feeds", body="""SELECT _commit_version, _change_type, count(*) AS cnt
      FROM feeds GROUP BY 1, 2"""),
    "change_split": build("feeds", body="""SELECT * EXCLUDE (_change_type, _commit_version, _commit_timestamp),
      _change_type AS _cdc_type, _commit_timestamp AS _cdc_timestamp
      FROM feeds WHERE _change_type IN ('insert', 'update_postimage')"""),
    "strip_meta": build("feed1", body="""SELECT * EXCLUDE (_change_type, _commit_version, _commit_timestamp)
      FROM feed1"""),
    "net_changes": plain("net"),
    "merge_upsert": build("book0", "book1", body="""SELECT * FROM book1
      UNION ALL SELECT * FROM book0 WHERE order_id NOT IN (SELECT order_id FROM book1)"""),
    "merge_update": build("source", "book1", body="""
      SELECT t.* REPLACE (
        CASE WHEN s.order_id IS NULL THEN t.tons_extracted
          ELSE CAST(trunc(t.tons_extracted * (CAST(0.9 AS DOUBLE)
            + CAST(('0x' || substr(md5(CAST(t.order_id AS VARCHAR)), 1, 8)) AS BIGINT)
              / CAST(4294967296 AS DOUBLE) * CAST(0.2 AS DOUBLE))) AS INTEGER) END AS tons_extracted,
        CASE WHEN s.order_id IS NULL THEN t.total_cost_usd
          ELSE t.tons_extracted * t.cost_per_ton_usd END AS total_cost_usd)
      FROM source t LEFT JOIN book1 s ON t.order_id = s.order_id"""),
    "delete_matching": build("book0", "feed1", body="""SELECT * FROM book0 WHERE order_id NOT IN
      (SELECT order_id FROM feed1 WHERE _change_type = 'delete')"""),
    "cdc_mirror": build("book0", "net", body="""
      SELECT *, 'insert' AS _cdc_type, TIMESTAMP '2001-01-01' AS _cdc_timestamp FROM book0
        WHERE order_id NOT IN (SELECT order_id FROM net)
      UNION ALL SELECT * EXCLUDE (_change_type, _commit_version, _commit_timestamp), _change_type,
        _commit_timestamp FROM net WHERE _change_type <> 'delete'"""),
    "audit_append": plain("audit"),
    "key_sample": build("source", body="""SELECT * FROM source
      WHERE CAST(('0x' || substr(md5(CAST(order_id AS VARCHAR)), 1, 8)) AS BIGINT)
        / CAST(4294967296 AS DOUBLE) < CAST(0.02 AS DOUBLE)"""),
    "incremental_slice": build("production", body="""SELECT * FROM production
      WHERE production_datetime > TIMESTAMP '2001-06-15'"""),
    "get_watermark": "SELECT coalesce(max(l_shipdate), TIMESTAMP '1970-01-01') AS watermark FROM lineitem",
    "align_schema": build("production", body="""SELECT CAST(site_id AS INTEGER) AS site_id,
      * EXCLUDE (site_id), CAST(NULL AS VARCHAR) AS note FROM production"""),
    # governance
    "masked_costs": build("daily", body="""SELECT * REPLACE (round(total_cost / 1000) * 1000 AS total_cost)
      FROM daily"""),
    "masked_latest_days": build("daily", body="""SELECT * REPLACE (round(total_cost / 1000) * 1000 AS total_cost)
      FROM daily ORDER BY production_date DESC, site_id LIMIT 10"""),
    "mask_cost": build("source", body="""SELECT order_id, total_cost_usd AS finance_cost,
      round(total_cost_usd / 1000) * 1000 AS other_cost FROM source"""),
    "filtered_risk": build("risk", body="SELECT * FROM risk WHERE site_status = 'Active'"),
    "partition_dispatch": build("production", body=f"""SELECT site_id, {TONS} AS tons, count(*) AS readings
      FROM production GROUP BY 1"""),
    # documents
    "page_text": r"""SELECT page_id, trim(regexp_replace(
        replace(replace(replace(replace(replace(replace(
          regexp_replace(regexp_replace(regexp_replace(html,
            '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g'),
            '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'),
          '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
        '\s+', ' ', 'g')) AS text FROM pages""",
    "document_chunks": plain("chunks"),
    "chunk_stats": build("chunks", body="SELECT count(*) AS chunks, count(DISTINCT path) AS docs FROM chunks"),
    "sync_chunks": plain("chunks"),
    "similar_topk": """SELECT vec_id, round(list_cosine_similarity(
          CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings
            WHERE vec_id = (SELECT min(vec_id) FROM embeddings))), 6) AS score
      FROM embeddings WHERE vec_id <> (SELECT min(vec_id) FROM embeddings)
      ORDER BY score DESC, vec_id LIMIT 3""",
}

# -- queries that write -------------------------------------------------------------

_PARTS_BY_YEAR = """SELECT version, 'closing' AS operation, done AS committed_at,
    CAST(count(DISTINCT y) AS BIGINT) AS parts FROM (
      SELECT CAST(0 AS BIGINT) AS version, TIMESTAMP '2001-01-01' AS done, year(production_date) AS y FROM book0
      UNION ALL SELECT 1, TIMESTAMP '2001-02-01', year(production_date) FROM book0
      UNION ALL SELECT 1, TIMESTAMP '2001-02-01', year(production_date) FROM book1
      UNION ALL SELECT 2, TIMESTAMP '2001-03-01', year(production_date) FROM book0
      UNION ALL SELECT 2, TIMESTAMP '2001-03-01', year(production_date) FROM book1
      UNION ALL SELECT 2, TIMESTAMP '2001-03-01', year(production_date) FROM book2)
    GROUP BY 1, 2, 3"""

_RESCUED = """SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN value END AS value,
    CASE WHEN event_type = 'error' THEN '{"value":"bad-' || event_id || '"}' END AS _rescued_data FROM events"""

ORACLE |= {
    "ingest_files": "SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data FROM lineitem",
    "evolve_schema": """SELECT * REPLACE (CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN props END AS props)
      FROM events""",
    "rescue_columns": _RESCUED,
    "rescue_typed_files": _RESCUED,
    "rescue_nested": """SELECT CASE WHEN whole THEN event_id END AS event_id,
        CASE WHEN whole AND event_type IS DISTINCT FROM 'error' THEN value END AS x, CASE WHEN whole THEN user_id END AS y,
        CASE WHEN whole THEN event_id END AS n0, CASE WHEN whole AND event_type IS DISTINCT FROM 'error' THEN 7::BIGINT END AS n1,
        CASE WHEN NOT whole THEN '{"_malformed":"{\\"event_id\\":' || event_id || ',\\"p\\":{"}'
             WHEN event_type = 'error' THEN '{"p.x":"bad-' || event_id || '","items[1].n":"none"}'
             WHEN event_type = 'click' THEN '{"p.z":"click"}' END AS _rescued_data
      FROM (SELECT *, event_id % 97 <> 0 AS whole FROM events)""",
    "evolve_nested": """SELECT event_id, value AS x, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN event_type END AS y,
        user_id AS a, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN event_id END AS b, CAST(NULL AS VARCHAR) AS _rescued_data FROM events""",
    "copy_into": plain("production"),
    "partitioned_source": build("production", body="""SELECT *, CAST(date_trunc('month', production_date) AS DATE)
      AS production_month FROM production"""),
    "read_binary": ORACLE["page_text"].replace("SELECT page_id,", "SELECT", 1),
    "load_targets": plain("targets"),
    "stream_table": ORACLE["silver_cleanse"],
    "stream_upsert": plain("fleet"),
    "stream_scd2": plain("history"),
    "stream_scd2_subset": ORACLE["scd2_subset"],
    "layers_production_by_site": ORACLE["production_by_site"],
    "layers_maintenance_due": f"SELECT * FROM ({ORACLE['maintenance_due']}) WHERE equipment_id > 0",
    "load_full": plain("daily"),
    "load_incremental": plain("daily"),
    "load_changed_parts": plain("daily"),
    "load_cdc": ORACLE["cdc_mirror"],
    "load_audit": plain("audit"),
    "load_state": build("audit", body="""SELECT unnest(['mirror', 'audit']) AS table_name,
      CAST(2 AS BIGINT) AS last_version, (SELECT max(_commit_version) FROM audit) AS audited_version"""),
    "as_of_version": plain("book1"),
    "as_of_time": plain("book1"),
    "ingest_new_files": "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-16'",
    "version_history": build("book0", "book1", "book2", body=_PARTS_BY_YEAR),
}
