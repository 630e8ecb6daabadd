"""The registered queries as SQL over the given tables.

Named parts build on each other the way the engine's tables do; `sql` puts the parts a query needs
in front of it. Ratios that end in a decimal are rounded half up with whole numbers.
"""

from __future__ import annotations

import re

from spendlens.plans.measures import ATTRIBUTION_DISCLAIMER

_DISCLAIMER = ATTRIBUTION_DISCLAIMER.replace("'", "''")

PARTS: dict[str, str] = {}
ORACLES: dict[str, str] = {}

# ------------------------------------------------------------------ events domain: staging

PARTS["ev"] = """
SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(18,4)) AS value,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(ts AS DATE) AS d,
       'user' || user_id AS u, 'org' || (user_id % 3) AS o
FROM events"""

_IDE = """CASE k % 6 WHEN 0 THEN 'vscode' WHEN 1 THEN 'visualstudio' WHEN 2 THEN 'intellij'
 WHEN 3 THEN 'eclipse' WHEN 4 THEN 'zed' ELSE 'someeditor' END"""
_FEATURE = """CASE k % 6 WHEN 0 THEN 'code_completion' WHEN 1 THEN 'agent_edit' WHEN 2 THEN 'copilot_cli'
 WHEN 3 THEN 'copilot_app' WHEN 4 THEN 'chat_inline' ELSE 'others' END"""
_FAMILY = """CASE {0} WHEN 'vscode' THEN 'VS Code' WHEN 'visualstudio' THEN 'Visual Studio'
 WHEN 'intellij' THEN 'JetBrains' WHEN 'eclipse' THEN 'Eclipse' WHEN 'zed' THEN 'Zed' ELSE 'Other' END"""
_GROUP = """CASE WHEN {0} = 'code_completion' THEN 'Completions' WHEN {0} = 'agent_edit' THEN 'Agent'
 WHEN {0} = 'copilot_cli' THEN 'CLI' WHEN {0} = 'copilot_app' THEN 'App'
 WHEN {0} LIKE 'chat%' THEN 'Chat' ELSE 'Other' END"""
_I = "CASE WHEN user_id % 5 = 0 THEN 0 ELSE k % 7 END"
_G = "CASE WHEN user_id % 10 = 0 THEN 0 ELSE k % 3 END"
_DISCOUNT = "CASE WHEN k % 10 = 0 THEN CAST(value * 0.1 AS DECIMAL(18,4)) ELSE CAST(0 AS DECIMAL(18,4)) END"

PARTS["prem"] = f"""
SELECT d, CASE WHEN k % 9 = 0 THEN upper(u) ELSE u END AS login, o, user_id, k, 'premium' AS product,
       'sku' || (k % 2) AS sku, 'model-' || (k % 4) AS model,
       CAST(0.04 + (k % 3) * 0.000125 AS DECIMAL(18,6)) AS price, CAST(k + 1 AS DECIMAL(18,4)) AS qty,
       value AS gross, {_DISCOUNT} AS discount, CAST(value - {_DISCOUNT} AS DECIMAL(18,4)) AS net
FROM ev WHERE event_type = 'purchase'"""
PARTS["ide"] = f"""
SELECT d, CASE WHEN k = 98 THEN 'ghost' || user_id ELSE u END AS login, o, user_id, k,
       CASE WHEN k = 97 THEN '' ELSE {_IDE} END AS ide, '1.' || (k % 20) AS ide_version,
       CASE WHEN k % 2 = 0 THEN '0.' || (k % 5) ELSE '' END AS plugin_version,
       {_I} AS interactions, {_G} AS generations, least({_G}, k % 2) AS acceptances,
       k * 2 AS suggested, k % 3 AS suggested_delete, k AS added, k % 11 AS deleted
FROM ev WHERE event_type IN ('click', 'view')"""
PARTS["mf"] = f"""
SELECT d, u AS login, o, user_id, k, 'model-' || (k % 4) AS model, {_FEATURE} AS feature,
       k % 3 AS interactions, k % 5 AS generations, k % 2 AS acceptances,
       k * 2 AS suggested, k % 3 AS suggested_delete, k AS added, k % 11 AS deleted
FROM ev WHERE event_type IN ('view', 'error')"""
PARTS["ud"] = f"""
SELECT d, u AS login, o, user_id, k, value AS credits,
       CASE WHEN user_id % 4 = 0 THEN 'No Cohort' ELSE 'Phase ' || (user_id % 4) END AS phase,
       CAST(user_id % 4 AS INTEGER) AS phase_number, k % 2 = 1 AS used_agent,
       CASE WHEN event_type = 'view' THEN true END AS used_chat,
       CASE WHEN event_type = 'click' THEN k % 5 = 0 END AS used_cli,
       {_I} AS interactions, {_G} AS generations, least({_G}, k % 2) AS acceptances,
       k * 2 AS suggested, k % 3 AS suggested_delete, k AS added, k % 11 AS deleted
FROM ev WHERE user_id % 37 <> 36"""
PARTS["teams"] = """
SELECT DISTINCT d, u AS login, o, user_id, t.team_id, 'team' || t.team_id AS slug
FROM ev, LATERAL (SELECT user_id % 10 AS team_id
                  UNION ALL SELECT 10 + user_id % 3 WHERE user_id % 4 = 0) t
WHERE user_id % 37 <> 36"""
PARTS["seats"] = f"""
SELECT u AS login, o, user_id, CASE WHEN user_id % 11 = 0 THEN '' ELSE 'team' || (user_id % 7) END AS team_name,
       CASE WHEN user_id % 2 = 0 THEN 'business' ELSE 'enterprise' END AS plan_type,
       CASE WHEN user_id % 8 = 0 THEN NULL WHEN user_id % 4 = 1 THEN last - INTERVAL 40 DAY ELSE last END AS last_at,
       CASE user_id % 6 WHEN 0 THEN 'vscode' WHEN 1 THEN 'visualstudio' WHEN 2 THEN 'intellij'
            WHEN 3 THEN 'eclipse' WHEN 4 THEN 'zed' ELSE 'someeditor' END AS editor
FROM (SELECT user_id, u, o, date_trunc('second', max(ts) + INTERVAL 500 MILLISECOND) AS last
      FROM ev WHERE user_id % 37 <> 36 GROUP BY user_id, u, o)"""

# ------------------------------------------------------------------ events domain: star schema

PARTS["dim_user"] = """
SELECT coalesce(s.uk, a.uk) AS uk, coalesce(s.login, a.login) AS user_login,
       coalesce(s.user_id, a.user_id) AS user_id, s.team_name,
       CASE WHEN coalesce(s.user_id, a.any_id) % 2 = 0 THEN 'cc' || (coalesce(s.user_id, a.any_id) % 5) END AS cost_center,
       s.plan_type, s.last_at, s.editor
FROM (SELECT lower(login) AS uk, login, user_id, nullif(team_name, '') AS team_name, plan_type, last_at, editor
      FROM seats) s
FULL JOIN (SELECT lower(login) AS uk, min(login) AS login, max(nullif(user_id, 0)) AS user_id, max(any_id) AS any_id
           FROM (SELECT login, user_id, user_id AS any_id FROM ud
                 UNION ALL SELECT login, NULL, user_id FROM prem
                 UNION ALL SELECT login, user_id, user_id FROM teams)
           GROUP BY lower(login)) a ON s.uk = a.uk"""
PARTS["fp"] = """
SELECT d, lower(login) AS uk, o, model, product, sku, sum(qty) AS qty, max(price) AS price,
       sum(gross) AS gross, sum(discount) AS discount, sum(net) AS net
FROM prem GROUP BY ALL"""
PARTS["fide"] = """
SELECT d, lower(login) AS uk, o, ide, max(ide_version) AS ide_version, max(plugin_version) AS plugin_version,
       sum(interactions) AS i, sum(generations) AS g, sum(acceptances) AS a, sum(added) AS added, sum(deleted) AS deleted
FROM ide WHERE ide <> '' AND lower(login) IN (SELECT uk FROM dim_user) GROUP BY ALL"""
PARTS["fmf"] = """
SELECT d, lower(login) AS uk, o, model, feature, sum(interactions) AS i, sum(generations) AS g, sum(acceptances) AS a
FROM mf WHERE lower(login) IN (SELECT uk FROM dim_user) GROUP BY ALL"""


def _half_up(part: str, whole: str, digits: int, decimal: str) -> str:
    """part / whole rounded half up to a decimal, through whole numbers."""
    scale = 10**digits
    unit = f"CAST({1 / scale:.{digits}f} AS DECIMAL({digits},{digits}))"
    number = f"(CAST({part} AS HUGEINT) * {2 * scale} + {whole}) // (2 * {whole})"
    return f"CAST(CAST({number} AS DECIMAL(18,0)) * {unit} AS {decimal})"


def _share(weights: list[tuple[str, str, str]], equal: bool) -> str:
    cases = " ".join(
        f"WHEN {total} > 0 THEN {_half_up(col, total, 8, 'DECIMAL(9,8)')}" for col, total, _ in weights
    )
    basis = " ".join(f"WHEN {total} > 0 THEN '{name}'" for _, total, name in weights)
    weight = " ".join(f"WHEN {total} > 0 THEN {col}" for col, total, _ in weights)
    fallback = _half_up("1", "n", 8, "DECIMAL(9,8)") if equal else "NULL"
    return f"""
SELECT d, uk, o, ide, CASE {cases} ELSE {fallback} END AS share,
       CASE {basis} ELSE 'equal_split' END AS basis
FROM (SELECT *, sum(i) OVER w AS ti, sum(g) OVER w AS tg, count(*) OVER w AS n FROM fide
      WINDOW w AS (PARTITION BY d, uk, o))
WHERE (CASE {weight} ELSE {'1' if equal else '0'} END) > 0"""


_BY_I = ("i", "ti", "user_interactions")
_BY_G = ("g", "tg", "code_generations")
PARTS["share"] = _share([_BY_I, _BY_G], True)
PARTS["share_generations"] = _share([_BY_G], True)
PARTS["share_no_fallback"] = _share([_BY_I, _BY_G], False)
PARTS["fshare"] = f"""
SELECT d, uk, o, model, feature,
       CASE WHEN t > 0 THEN {_half_up('i', 't', 8, 'DECIMAL(18,8)')}
            ELSE {_half_up('1', 'n', 8, 'DECIMAL(18,8)')} END AS share
FROM (SELECT *, sum(i) OVER w AS t, count(*) OVER w AS n FROM fmf
      WINDOW w AS (PARTITION BY d, uk, o, model))"""


def _alloc(column: str) -> str:
    product = (
        f"CAST(f.{column} AS DECIMAL(18,4)) * coalesce(s.share, CAST(1 AS DECIMAL(9,8))) "
        "* coalesce(x.share, CAST(1 AS DECIMAL(18,8)))"
    )
    return f"CAST(CAST({product} AS DECIMAL(38,11)) AS DECIMAL(18,6))"


PARTS["v1"] = f"""
SELECT f.d AS usage_date, strftime(f.d, '%Y-%m') AS year_month, u.user_login, u.team_name, u.cost_center,
       f.o AS org_login, f.model AS model_name, f.product, f.sku,
       coalesce(s.ide, 'unattributed') AS editor_name,
       CASE WHEN s.ide IS NULL THEN 'Unattributed' ELSE {_FAMILY.format('s.ide')} END AS editor_family,
       coalesce(x.feature, 'unattributed') AS feature,
       CASE WHEN x.feature IS NULL THEN 'Unattributed' ELSE {_GROUP.format('x.feature')} END AS feature_group,
       coalesce(s.share, CAST(1 AS DECIMAL(9,8))) AS ide_share,
       coalesce(x.share, CAST(1 AS DECIMAL(18,8))) AS feature_share, s.basis AS weight_basis,
       {_alloc('net')} AS allocated_net_amount, {_alloc('gross')} AS allocated_gross_amount,
       {_alloc('qty')} AS allocated_quantity,
       CASE WHEN s.share IS NULL AND x.share IS NULL THEN 'exact-unallocated'
            WHEN s.share IS NULL THEN 'feature-only' ELSE 'modelled' END AS attribution_quality,
       f.uk
FROM fp f JOIN dim_user u ON u.uk = f.uk
LEFT JOIN share s ON s.d = f.d AND s.uk = f.uk AND s.o = f.o
LEFT JOIN fshare x ON x.d = f.d AND x.uk = f.uk AND x.o = f.o AND x.model = f.model"""
PARTS["v2"] = """
SELECT f.d AS usage_date, strftime(f.d, '%Y-%m') AS year_month, u.user_login, u.team_name, u.cost_center,
       f.o AS org_login, f.model AS model_name, f.sku, CAST(sum(f.qty) AS DECIMAL(38,4)) AS quantity,
       CAST(sum(f.gross) AS DECIMAL(38,4)) AS gross_amount,
       CAST(sum(f.discount) AS DECIMAL(38,4)) AS discount_amount,
       CAST(sum(f.net) AS DECIMAL(38,4)) AS net_amount, f.uk
FROM fp f JOIN dim_user u ON u.uk = f.uk GROUP BY ALL"""
PARTS["idle"] = """
SELECT u.user_login, u.team_name, u.plan_type, strftime(u.last_at, '%Y-%m-%d %H:%M:%S') AS last_activity_at,
       CAST(date_diff('day', CAST(u.last_at AS DATE), DATE '2024-01-31') AS INTEGER) AS days_since_activity,
       CAST(coalesce(s.net, 0) AS DECIMAL(38,4)) AS net_amount_30d
FROM dim_user u LEFT JOIN (SELECT uk, sum(net) AS net FROM fp WHERE d >= DATE '2024-01-01' GROUP BY uk) s ON s.uk = u.uk
WHERE u.last_at IS NULL OR u.last_at < TIMESTAMP '2024-01-31' - INTERVAL 30 DAY"""

# ------------------------------------------------------------------ run log

PARTS["runs"] = """
SELECT 'run-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS run_id, date_trunc('second', ts) AS started_at, k, d,
       k % 7 <> 0 AS done, date_trunc('second', ts) + to_minutes(k) AS ended_at
FROM ev WHERE event_type = 'signup'"""
PARTS["states"] = """
SELECT run_id, CASE WHEN done THEN strftime(ended_at, '%Y-%m-%d %H:%M:%S')
                    WHEN started_at < TIMESTAMP '2024-01-31' - INTERVAL 120 MINUTE THEN '2024-01-31 00:00:00' END AS completed_at,
       CAST(d - 7 AS DATE) AS since_date, d AS until_date,
       CASE WHEN k % 4 = 0 THEN 'backfill' ELSE 'timer' END AS trigger_source,
       CASE WHEN done AND k % 5 = 0 THEN 'failed' WHEN done THEN 'succeeded'
            WHEN started_at < TIMESTAMP '2024-01-31' - INTERVAL 120 MINUTE THEN 'abandoned' ELSE 'running' END AS status,
       CASE WHEN done THEN CAST(k AS BIGINT) END AS rows_user_day,
       CASE WHEN done THEN CAST(k * 2 AS BIGINT) END AS rows_user_ide,
       CASE WHEN done THEN CAST(k * 4 AS BIGINT) END AS rows_premium_requests,
       CASE WHEN done AND k % 5 = 0 THEN 'TimeoutError - see the job log for detail'
            WHEN NOT done AND started_at < TIMESTAMP '2024-01-31' - INTERVAL 120 MINUTE
            THEN 'Abandoned: ran too long without completing.' END AS message, started_at,
       CASE WHEN done THEN CAST(k * 3 AS BIGINT) END AS rows_model_feature, CASE WHEN done THEN CAST(10 AS BIGINT) END AS rows_seats
FROM runs"""

# ------------------------------------------------------------------ orders domain

PARTS["ol"] = """
SELECT c_custkey AS user_id, c_name AS u, 'nation' || c_nationkey AS o, CAST(l_shipdate AS DATE) AS d,
       l_linenumber, l_returnflag, p_brand, p_type, CAST(l_quantity AS INTEGER) AS q,
       CAST(l_extendedprice AS DECIMAL(18,4)) AS price, CAST(l_discount AS DECIMAL(18,4)) AS disc
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey"""
PARTS["ofp"] = """
SELECT d, lower(u) AS uk, u, o, p_brand AS model, p_type AS product, l_returnflag AS sku, user_id,
       sum(CAST(q AS DECIMAL(18,4))) AS qty, sum(price) AS gross,
       sum(price - CAST(price * disc AS DECIMAL(18,4))) AS net
FROM ol GROUP BY ALL"""
PARTS["ofide"] = """
SELECT d, lower(u) AS uk, o, CASE l_linenumber % 6 WHEN 0 THEN 'vscode' WHEN 1 THEN 'visualstudio' WHEN 2 THEN 'intellij'
       WHEN 3 THEN 'eclipse' WHEN 4 THEN 'zed' ELSE 'someeditor' END AS ide,
       sum(CASE WHEN user_id % 5 = 0 THEN 0 ELSE q END) AS i,
       sum(CASE WHEN user_id % 10 = 0 THEN 0 ELSE l_linenumber END) AS g
FROM ol GROUP BY ALL"""
PARTS["ofmf"] = """
SELECT d, lower(u) AS uk, o, p_brand AS model,
       CASE q % 6 WHEN 0 THEN 'code_completion' WHEN 1 THEN 'agent_edit' WHEN 2 THEN 'copilot_cli'
       WHEN 3 THEN 'copilot_app' WHEN 4 THEN 'chat_inline' ELSE 'others' END AS feature,
       sum(CASE WHEN user_id % 5 = 0 THEN 0 ELSE q END) AS i
FROM ol GROUP BY ALL"""
PARTS["oshare"] = _share([_BY_I, _BY_G], True).replace("FROM fide", "FROM ofide")
PARTS["ofshare"] = PARTS["fshare"].replace("FROM fmf", "FROM ofmf")
PARTS["ov1"] = f"""
SELECT f.d AS usage_date, f.u AS user_login, f.o AS org_login, f.model AS model_name, f.product, f.sku,
       coalesce(s.ide, 'unattributed') AS editor_name,
       CASE WHEN s.ide IS NULL THEN 'Unattributed' ELSE {_FAMILY.format('s.ide')} END AS editor_family,
       coalesce(x.feature, 'unattributed') AS feature, s.basis AS weight_basis,
       {_alloc('net')} AS allocated_net_amount, {_alloc('qty')} AS allocated_quantity
FROM ofp f LEFT JOIN oshare s ON s.d = f.d AND s.uk = f.uk AND s.o = f.o
LEFT JOIN ofshare x ON x.d = f.d AND x.uk = f.uk AND x.o = f.o AND x.model = f.model"""


# ------------------------------------------------------------------ assembly


def sql(query: str) -> str:
    """The query with the parts it names, and the parts those name, in front."""
    order: list[str] = []

    def need(text: str) -> None:
        for word in re.findall(r"\b[a-z_0-9]+\b", text):
            if word in PARTS and word not in order:
                if re.search(rf"\b(FROM|JOIN|,)\s*\(?{word}\b", text) is None:
                    continue
                need(PARTS[word])
                if word not in order:
                    order.append(word)

    need(query)
    if not order:
        return query.strip()
    parts = ",\n".join(f"{name} AS MATERIALIZED ({PARTS[name].strip()})" for name in order)
    return f"WITH {parts}\n{query.strip()}"


RAW: dict[str, str] = {}


def oracle(name: str, query: str) -> None:
    RAW[name], ORACLES[name] = query, sql(query)


def restricted_oracle(name: str, query: str, visible: str) -> None:
    """The query over facts that are cut to the users of a condition on dim_user."""
    whole = dict(PARTS)
    PARTS["visible"] = f"SELECT uk FROM dim_user WHERE {visible}"
    for fact in ("fp", "fide", "fmf"):
        PARTS[f"all_{fact}"] = whole[fact]
        PARTS[fact] = f"SELECT * FROM all_{fact} WHERE uk IN (SELECT uk FROM visible)"
    oracle(name, query)
    PARTS.clear()
    PARTS.update(whole)


_COUNTS7 = """CAST(sum(interactions) AS BIGINT) AS user_initiated_interaction_count,
 CAST(sum(generations) AS BIGINT) AS code_generation_activity_count,
 CAST(sum(acceptances) AS BIGINT) AS code_acceptance_activity_count,
 CAST(sum(suggested) AS BIGINT) AS loc_suggested_to_add_sum,
 CAST(sum(suggested_delete) AS BIGINT) AS loc_suggested_to_delete_sum,
 CAST(sum(added) AS BIGINT) AS loc_added_sum, CAST(sum(deleted) AS BIGINT) AS loc_deleted_sum"""
_T = "DECIMAL(38,4)"
_A = "DECIMAL(38,6)"

# ------------------------------------------------------------------ sources and flatteners

oracle("report_records", """
SELECT user_id, CAST(sum(CASE WHEN k < 10 THEN 2 ELSE 1 END) AS BIGINT) AS records,
       CAST(sum(CASE WHEN k < 10 THEN 2 ELSE 1 END * k) AS BIGINT) AS interactions
FROM ev WHERE k > 1 GROUP BY user_id""")
oracle("report_quality", """
SELECT CAST(count(*) FILTER (k > 0) AS BIGINT) AS lines, CAST(count(*) FILTER (k = 1) AS BIGINT) AS malformed,
       CAST(sum(CASE WHEN k < 2 THEN 0 WHEN k < 10 THEN 2 ELSE 1 END) AS BIGINT) AS records, false AS unreadable
FROM ev""")
oracle("raw_latest", """
SELECT 'users_1_day' AS dataset, d AS dt, o AS org,
       CASE WHEN d < DATE '2024-01-08' THEN '20240115T020000Z' ELSE '20240131T020000Z' END AS stamp,
       count(DISTINCT login) AS records
FROM ud GROUP BY ALL
UNION ALL
SELECT 'user_teams_1_day', d, o,
       CASE WHEN d < DATE '2024-01-08' THEN '20240115T020000Z' ELSE '20240131T020000Z' END, count(*)
FROM teams GROUP BY ALL
UNION ALL
SELECT 'seats', DATE '2024-01-30', o, '20240131T020000Z', count(*) FROM seats GROUP BY ALL""")
oracle("raw_expired_partitions", """
SELECT dataset, dt FROM (
  SELECT 'users_1_day' AS dataset, d AS dt FROM ud UNION SELECT 'user_teams_1_day', d FROM teams
  UNION SELECT 'premium_requests', DATE '2024-01-14' FROM prem WHERE d <= DATE '2024-01-14'
  UNION SELECT 'seats', DATE '2024-01-14' FROM seats)
WHERE dt < DATE '2024-01-21'""")
oracle("flatten_user_day", f"""
SELECT d AS activity_date, login AS user_login, user_id, o AS org_login,
       CAST(user_id % 3 AS VARCHAR) AS organization_id, '1' AS enterprise_id,
       CAST(sum(credits) * CASE WHEN d < DATE '2024-01-08' THEN 2 ELSE 1 END AS DECIMAL(18,4)) AS ai_credits_used,
       max(phase) AS adoption_phase, max(phase_number) AS adoption_phase_number,
       bool_or(used_agent) AS used_agent, bool_or(used_chat) AS used_chat, bool_or(used_cli) AS used_cli,
       CAST(NULL AS BOOLEAN) AS used_code_review_active, CAST(NULL AS BOOLEAN) AS used_code_review_passive,
       CAST(NULL AS BOOLEAN) AS used_copilot_app, CAST(NULL AS BOOLEAN) AS used_copilot_cloud_agent, {_COUNTS7}
FROM ud GROUP BY d, login, user_id, o""")
oracle("flatten_user_ide", f"""
SELECT d AS activity_date, login AS user_login, o AS org_login,
       CASE WHEN ide <> '' THEN ide WHEN length(login) % 2 = 0 THEN '' ELSE 'unknown' END AS ide,
       {_FAMILY.format('ide')} AS ide_family, '1.0' AS last_known_ide_version, '' AS last_known_plugin_version,
       {_COUNTS7}
FROM ide WHERE user_id % 37 <> 36 AND k <> 98 GROUP BY d, login, o, ide""")
oracle("flatten_user_model_feature", f"""
SELECT d AS activity_date, login AS user_login, o AS org_login, model AS model_name, feature, {_COUNTS7}
FROM mf WHERE user_id % 37 <> 36 GROUP BY ALL""")
oracle("flatten_user_teams", """
SELECT d AS activity_date, login AS user_login, user_id, o AS org_login, team_id, slug AS team_slug FROM teams""")
oracle("billing_day_folders", """
SELECT DISTINCT d AS usage_date, DATE '2024-01-14' AS dt FROM prem WHERE d BETWEEN DATE '2024-01-01' AND DATE '2024-01-14'
UNION ALL
SELECT DISTINCT d, DATE '2024-01-30' FROM prem WHERE d BETWEEN DATE '2024-01-08' AND DATE '2024-01-30'""")
_FLAT_BILLING = """
SELECT d AS usage_date, login AS user_login, o AS org_login, product, sku, model AS model_name,
       'request' AS unit_type, max(price) AS price_per_unit, CAST(sum(qty) AS DECIMAL(18,4)) AS gross_quantity,
       CAST(0 AS DECIMAL(18,4)) AS discount_quantity, CAST(sum(qty) AS DECIMAL(18,4)) AS net_quantity,
       CAST(sum(gross) * m AS DECIMAL(18,4)) AS gross_amount,
       CAST(sum(discount) * m AS DECIMAL(18,4)) AS discount_amount, CAST(sum(net) * m AS DECIMAL(18,4)) AS net_amount
FROM (SELECT *, CASE WHEN d < DATE '2024-01-08' THEN 2 ELSE 1 END AS m FROM prem{})
GROUP BY d, login, o, product, sku, model, m"""
oracle("flatten_premium_requests", _FLAT_BILLING.format(""))
oracle("billing_one_day", _FLAT_BILLING.format(" WHERE d = DATE '2024-01-05'"))
oracle("flatten_seats", """
SELECT login AS user_login, user_id, o AS org_login, team_name, plan_type, '2023-12-01 00:00:00' AS created_at,
       strftime(last_at, '%Y-%m-%d %H:%M:%S') AS last_activity_at, editor AS last_activity_editor,
       CAST(NULL AS DATE) AS pending_cancellation_date
FROM seats""")
oracle("ide_family_labels", f"""
SELECT ide, {_FAMILY.format('ide')} AS ide_family, count(*) AS rows FROM ide GROUP BY ALL""")

# ------------------------------------------------------------------ dimensions

oracle("dim_date", """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, monthname(d) AS month_name,
       strftime(d, '%Y-%m') AS year_month, CAST(isodow(d) AS INTEGER) AS day_of_week, isodow(d) >= 6 AS is_weekend
FROM (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP), CAST(last_day(hi) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT min(d) AS lo, max(d) AS hi FROM ev WHERE user_id % 37 <> 36 OR event_type = 'purchase'))""")
oracle("dim_org", "SELECT DISTINCT o AS org_key, o AS org_login FROM ev")
oracle("dim_editor", f"""
SELECT DISTINCT ide AS editor_key, ide AS editor_name, {_FAMILY.format('ide')} AS editor_family FROM ide WHERE ide <> ''""")
oracle("dim_feature", f"""
SELECT DISTINCT feature AS feature_key, feature, {_GROUP.format('feature')} AS feature_group FROM mf""")
oracle("dim_model", """
SELECT DISTINCT model AS model_key, model AS model_name, false AS is_custom_model
FROM (SELECT model FROM mf UNION SELECT model FROM prem)""")
oracle("dim_product", """
SELECT DISTINCT length(product) || ':' || product || ':' || sku AS product_key, product, sku, 'request' AS unit_type FROM prem""")
oracle("dim_user", """
SELECT uk AS user_key, user_login, user_id AS external_user_id, team_name, cost_center, plan_type,
       strftime(last_at, '%Y-%m-%d %H:%M:%S') AS last_activity_at, editor AS last_activity_editor, true AS is_active
FROM dim_user""".replace("user_id AS", "nullif(user_id, 0) AS"))
oracle("dim_team", """
SELECT DISTINCT team_id || ':' || o AS team_key, team_id, slug AS team_slug, o AS org_key FROM teams""")
oracle("dim_numbering", """
SELECT dimension, n AS rows, CAST(1 AS BIGINT) AS lowest, n AS highest, n AS numbers FROM (
  SELECT 'dim_user' AS dimension, count(*) AS n FROM dim_user
  UNION ALL SELECT 'dim_org', count(DISTINCT o) FROM ev
  UNION ALL SELECT 'dim_team', count(DISTINCT (team_id, o)) FROM teams
  UNION ALL SELECT 'dim_editor', count(DISTINCT ide) FROM ide WHERE ide <> ''
  UNION ALL SELECT 'dim_model', count(DISTINCT model) FROM (SELECT model FROM prem UNION ALL SELECT model FROM mf)
  UNION ALL SELECT 'dim_product', count(DISTINCT (product, sku)) FROM prem
  UNION ALL SELECT 'dim_feature', count(DISTINCT feature) FROM mf)""")

# ------------------------------------------------------------------ facts

_KEY = "CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key"
oracle("fact_premium_requests", f"""
SELECT {_KEY}, uk AS user_key, o AS org_key, model AS model_key,
       length(product) || ':' || product || ':' || sku AS product_key, CAST(qty AS DECIMAL(18,4)) AS net_quantity,
       CAST(qty AS DECIMAL(18,4)) AS gross_quantity, price AS price_per_unit, CAST(gross AS DECIMAL(18,4)) AS gross_amount,
       CAST(discount AS DECIMAL(18,4)) AS discount_amount, CAST(net AS DECIMAL(18,4)) AS net_amount FROM fp""")
oracle("fact_user_day", f"""
SELECT {_KEY}, lower(login) AS user_key, o AS org_key, CAST(sum(credits) AS DECIMAL(18,4)) AS ai_credits_used,
       max(phase) AS adoption_phase, max(phase_number) AS adoption_phase_number, bool_or(used_agent) AS used_agent,
       bool_or(used_chat) AS used_chat, bool_or(used_cli) AS used_cli, CAST(NULL AS BOOLEAN) AS used_copilot_app,
       CAST(NULL AS BOOLEAN) AS used_copilot_cloud_agent, CAST(NULL AS BOOLEAN) AS used_code_review_active,
       CAST(NULL AS BOOLEAN) AS used_code_review_passive, CAST(sum(interactions) AS BIGINT) AS user_initiated_interaction_count,
       CAST(sum(generations) AS BIGINT) AS code_generation_activity_count,
       CAST(sum(acceptances) AS BIGINT) AS code_acceptance_activity_count,
       CAST(sum(suggested) AS BIGINT) AS loc_suggested_to_add_sum, CAST(sum(added) AS BIGINT) AS loc_added_sum,
       CAST(sum(deleted) AS BIGINT) AS loc_deleted_sum
FROM ud GROUP BY d, lower(login), o""")
_FCOUNTS = """CAST(i AS BIGINT) AS user_initiated_interaction_count, CAST(g AS BIGINT) AS code_generation_activity_count,
 CAST(a AS BIGINT) AS code_acceptance_activity_count"""
oracle("fact_user_ide_day", f"""
SELECT {_KEY}, uk AS user_key, o AS org_key, ide AS editor_key, ide_version AS last_known_ide_version,
       plugin_version AS last_known_plugin_version, {_FCOUNTS}, CAST(added AS BIGINT) AS loc_added_sum,
       CAST(deleted AS BIGINT) AS loc_deleted_sum FROM fide""")
oracle("fact_user_model_feature_day", f"""
SELECT {_KEY}, uk AS user_key, o AS org_key, model AS model_key, feature AS feature_key, {_FCOUNTS} FROM fmf""")
oracle("fact_user_team_day", f"""
SELECT {_KEY}, login AS user_key, team_id || ':' || o AS team_key FROM teams""")
for _name, _part in (("ide_share", "share"), ("ide_share_generations", "share_generations"),
                     ("ide_share_no_fallback", "share_no_fallback")):
    oracle(_name, f"""
SELECT {_KEY}, uk AS user_key, o AS org_key, ide AS editor_key, share, basis AS weight_basis FROM {_part}""")
oracle("feature_share", f"""
SELECT {_KEY}, uk AS user_key, o AS org_key, model AS model_key, feature AS feature_key, share FROM fshare""")
oracle("spend_shares", f"""
SELECT {_KEY}, uk AS user_key, o AS org_key, model AS model_key,
       length(product) || ':' || product || ':' || sku AS product_key, CAST(net AS DECIMAL(18,4)) AS net_amount,
       CAST(gross AS DECIMAL(18,4)) AS gross_amount, CAST(qty AS DECIMAL(18,4)) AS net_quantity,
       (SELECT string_agg(s.ide || '/' || s.share || '/' || s.basis, ',' ORDER BY s.ide) FROM share s
        WHERE s.d = f.d AND s.uk = f.uk AND s.o = f.o) AS editors,
       (SELECT string_agg(x.feature || '/' || x.share, ',' ORDER BY x.feature) FROM fshare x
        WHERE x.d = f.d AND x.uk = f.uk AND x.o = f.o AND x.model = f.model) AS features
FROM fp f""")
oracle("upsert_corrections", f"""
SELECT d AS usage_date, CAST(sum(net * CASE WHEN d >= DATE '2024-01-23' THEN 1 ELSE 2 END) AS {_T}) AS net_amount,
       count(*) AS rows FROM fp GROUP BY d""")
oracle("reload_window_rows", """
SELECT dataset, CAST(n AS BIGINT) AS rows FROM (
  SELECT 'user_day' AS dataset, count(*) AS n FROM ud WHERE d BETWEEN DATE '2024-01-23' AND DATE '2024-01-30'
  UNION ALL SELECT 'user_ide', count(*) FROM ide WHERE d BETWEEN DATE '2024-01-23' AND DATE '2024-01-30'
  UNION ALL SELECT 'user_model_feature', count(*) FROM mf WHERE d BETWEEN DATE '2024-01-23' AND DATE '2024-01-30'
  UNION ALL SELECT 'user_teams', count(*) FROM teams WHERE d BETWEEN DATE '2024-01-23' AND DATE '2024-01-30'
  UNION ALL SELECT 'premium_requests', count(*) FROM prem WHERE d BETWEEN DATE '2024-01-23' AND DATE '2024-01-30'
  UNION ALL SELECT 'seats', count(*) FROM seats)""")

# ------------------------------------------------------------------ views

oracle("spend_by_user_model_editor", "SELECT * EXCLUDE (uk) FROM v1")
oracle("spend_by_user_model", "SELECT * EXCLUDE (uk) FROM v2")
oracle("monthly_spend_by_team", f"""
SELECT year_month, coalesce(cost_center, team_name, 'unassigned') AS cost_center, org_login, model_name,
       count(DISTINCT uk) AS active_users, CAST(sum(net_amount) AS {_T}) AS net_amount FROM v2 GROUP BY ALL""")
_EDITOR_MIX = f"""
SELECT d AS activity_date, strftime(d, '%Y-%m') AS year_month, o AS org_login, ide AS editor_name,
       {_FAMILY.format('ide')} AS editor_family, count(DISTINCT uk) AS active_users, CAST(sum(i) AS BIGINT) AS interactions,
       CAST(sum(g) AS BIGINT) AS generations, CAST(sum(a) AS BIGINT) AS acceptances, CAST(sum(added) AS BIGINT) AS loc_added,
       CAST(sum(deleted) AS BIGINT) AS loc_deleted,
       CASE WHEN sum(g) > 0 THEN {_half_up('sum(a)', 'sum(g)', 4, 'DECIMAL(9,4)')} END AS acceptance_rate
FROM fide GROUP BY ALL"""
oracle("editor_mix", _EDITOR_MIX)
oracle("model_feature_mix", f"""
SELECT f.d AS activity_date, strftime(f.d, '%Y-%m') AS year_month, f.o AS org_login, u.user_login, f.model AS model_name,
       f.feature, {_GROUP.format('f.feature')} AS feature_group, CAST(f.i AS BIGINT) AS interactions,
       CAST(f.g AS BIGINT) AS generations, CAST(f.a AS BIGINT) AS acceptances
FROM fmf f JOIN dim_user u ON u.uk = f.uk""")
oracle("spend_by_team", f"""
SELECT strftime(f.d, '%Y-%m') AS year_month, f.o AS org_login, t.slug AS team_slug, f.model AS model_name,
       count(DISTINCT f.uk) AS active_users, CAST(sum(f.net) AS {_T}) AS net_amount
FROM fp f JOIN teams t ON t.d = f.d AND t.login = f.uk GROUP BY ALL""")
oracle("inactive_seats", "SELECT * FROM idle")

# ------------------------------------------------------------------ questions (window 2024-01-05 .. 2024-01-25)

_W = "usage_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'"
_R = "usage_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'"
_BREAKDOWN = f"""
SELECT model_name, editor_family, feature, attribution_quality, CAST(sum(allocated_net_amount) AS {_A}) AS spend,
       CAST(sum(allocated_quantity) AS {_A}) AS requests FROM v1 WHERE uk = '{{0}}' AND {{1}}
GROUP BY ALL HAVING sum(allocated_net_amount) > 0"""
oracle("user_breakdown", _BREAKDOWN.format("user1", _W))
oracle("user_exact_total", f"""
SELECT CAST(coalesce(sum(net_amount), 0) AS {_T}) AS net_amount, CAST(coalesce(sum(quantity), 0) AS {_T}) AS quantity,
       count(DISTINCT model_name) AS models_used FROM v2 WHERE uk = 'user1' AND {_W}""")
oracle("user_exact_total_unknown", f"""
SELECT CAST(coalesce(sum(net_amount), 0) AS {_T}) AS net_amount, CAST(coalesce(sum(quantity), 0) AS {_T}) AS quantity,
       count(DISTINCT model_name) AS models_used FROM v2 WHERE uk = 'nobody' AND {_W}""")
oracle("top_spenders", f"""
SELECT user_login, team_name, cost_center, CAST(sum(net_amount) AS {_T}) AS spend FROM v2 WHERE {_W}
GROUP BY ALL ORDER BY spend DESC, user_login LIMIT 25""")
oracle("top_spenders_all", f"""
SELECT user_login, team_name, cost_center, CAST(sum(net_amount) AS {_T}) AS spend FROM v2 WHERE {_W} GROUP BY ALL""")
_TEAM = "coalesce(cost_center, team_name, 'unassigned')"
oracle("team_breakdown", f"""
SELECT user_login, model_name, CAST(sum(net_amount) AS {_T}) AS spend FROM v2 WHERE {_TEAM} = 'cc0' AND {_W} GROUP BY ALL""")
oracle("team_total", f"SELECT CAST(sum(net_amount) AS {_T}) AS total FROM v2 WHERE {_TEAM} = 'cc0' AND {_W}")
_SUMMARY = f"""
SELECT CAST(coalesce(sum(net_amount), 0) AS {_T}) AS total_spend, count(DISTINCT user_login) AS active_users,
       count(DISTINCT model_name) AS models_used, CAST(coalesce(sum(quantity), 0) AS {_T}) AS total_requests
FROM v2 WHERE {{0}}"""
oracle("summary", _SUMMARY.format(_W))
_EDITOR_SPEND = f"""
SELECT editor_family, feature, CAST(sum(allocated_net_amount) AS {_A}) AS spend FROM v1 WHERE {_W}
GROUP BY ALL HAVING sum(allocated_net_amount) > 0"""
oracle("editor_spend", _EDITOR_SPEND)
oracle("data_freshness", """
SELECT (SELECT max(d) FROM fp) AS latest_billing_date, (SELECT max(d) FROM ud) AS latest_activity_date,
       (SELECT max(completed_at) FROM states WHERE status = 'succeeded') AS last_successful_run""")
oracle("freshness_by_fact", """
SELECT 'premium_requests' AS fact, max(d) AS latest_date FROM fp
UNION ALL SELECT 'user_day', max(d) FROM ud UNION ALL SELECT 'user_ide', max(d) FROM fide""")
oracle("weight_basis_counts", "SELECT basis AS weight_basis, count(*) AS rows FROM share GROUP BY basis")
oracle("run_states", "SELECT * REPLACE (strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at) FROM states")
oracle("recent_runs", """
SELECT * EXCLUDE (started_at, rows_model_feature, rows_seats) FROM (SELECT * FROM states ORDER BY started_at DESC, run_id DESC LIMIT 5)""")
oracle("ingestion_stalled", """
SELECT count(*) FILTER (status = 'succeeded' AND completed_at BETWEEN '2024-01-29 00:00:00' AND '2024-01-31 00:00:00') < 1 AS stalled
FROM states""")
oracle("month_of_user", f"""
SELECT user_login, model_name, editor_family, feature, CAST(sum(allocated_net_amount) AS {_A}) AS spend
FROM v1 WHERE uk = 'user1' AND year_month = '2024-01' GROUP BY ALL""")
oracle("month_exact", f"""
SELECT user_login, model_name, CAST(sum(net_amount) AS {_T}) AS spend FROM v2 WHERE year_month = '2024-01' GROUP BY ALL""")
oracle("idle_seats_by_age", "SELECT * FROM idle")


def _money(c: str) -> str:
    return f"'$' || format('{{:,.2f}}', CAST({c} AS DOUBLE))"


_ORDER = "spend DESC, model_name, editor_family, feature, attribution_quality"
oracle("user_report", f"""
SELECT 0 AS position, 'Total (exact)' AS name, {_money('sum(net_amount)')} AS value
FROM v2 WHERE uk = 'user1' AND {_R} HAVING sum(net_amount) <> 0
UNION ALL SELECT CAST(row_number() OVER (ORDER BY {_ORDER}) AS INTEGER), model_name || ' · ' || editor_family || ' · ' || feature,
       {_money('spend')}
FROM (SELECT * FROM ({_BREAKDOWN.format('user1', _R)}) ORDER BY {_ORDER} LIMIT 12)""")
oracle("team_report", f"""
SELECT 0 AS position, 'Total' AS name, {_money('sum(net_amount)')} AS value FROM v2 WHERE {_TEAM} = 'cc0' AND {_R}
UNION ALL SELECT CAST(row_number() OVER (ORDER BY spend DESC, user_login, model_name) AS INTEGER),
       user_login || ' · ' || model_name, {_money('spend')}
FROM (SELECT user_login, model_name, sum(net_amount) AS spend FROM v2 WHERE {_TEAM} = 'cc0' AND {_R} GROUP BY ALL
      ORDER BY spend DESC, user_login, model_name LIMIT 15)""")
oracle("top_report", f"""
SELECT CAST(row_number() OVER (ORDER BY spend DESC, user_login) AS INTEGER) AS position, user_login AS name, {_money('spend')} AS value
FROM (SELECT user_login, sum(net_amount) AS spend FROM v2 WHERE {_R} GROUP BY ALL ORDER BY spend DESC, user_login LIMIT 10)""")
oracle("summary_report", f"""
SELECT position, name, value FROM ({_SUMMARY.format(_R)}) s, LATERAL (
  SELECT 1 AS position, 'Total spend' AS name, {_money('s.total_spend')} AS value
  UNION ALL SELECT 2, 'Active users', CAST(s.active_users AS VARCHAR)
  UNION ALL SELECT 3, 'Models used', CAST(s.models_used AS VARCHAR)
  UNION ALL SELECT 4, 'Premium requests', format('{{:,.0f}}', CAST(s.total_requests AS DOUBLE)))""")

# ------------------------------------------------------------------ measures


def _div(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


_EXACT = f"""CAST(sum(net_amount) AS {_T}) AS total_spend, CAST(sum(gross_amount) AS {_T}) AS gross_spend,
 CAST(sum(discount_amount) AS {_T}) AS discount, CAST(sum(quantity) AS {_T}) AS premium_requests,
 count(DISTINCT user_login) AS active_users, count(DISTINCT model_name) AS models_used,
 {_div('sum(net_amount)', 'count(DISTINCT user_login)')} AS spend_per_active_user,
 {_div('sum(net_amount)', 'sum(quantity)')} AS cost_per_premium_request"""
oracle("exact_measures", f"SELECT org_login, cost_center, {_EXACT} FROM v2 GROUP BY ALL")
oracle("exact_measures_total", f"SELECT {_EXACT} FROM v2")
_UN = "sum(allocated_net_amount) FILTER (attribution_quality = 'exact-unallocated')"
_EQ = "sum(allocated_net_amount) FILTER (weight_basis = 'equal_split')"
_ALLOC = f"""CAST(sum(allocated_net_amount) AS {_A}) AS total_spend_allocated,
 CAST(sum(allocated_quantity) AS {_A}) AS allocated_requests, CAST({_UN} AS {_A}) AS unallocated_spend,
 {_div(_UN, 'sum(allocated_net_amount)')} AS unallocated_pct,
 {_div(_EQ, 'sum(allocated_net_amount)')} AS equal_split_fallback_pct"""
oracle("allocated_measures", f"SELECT org_login, model_name, {_ALLOC} FROM v1 GROUP BY ALL")
oracle("editor_share", f"""
SELECT org_login, editor_family, total_spend_allocated,
       {_div('total_spend_allocated', 'sum(total_spend_allocated) OVER (PARTITION BY org_login)')} AS editor_share_pct
FROM (SELECT org_login, editor_family, CAST(sum(allocated_net_amount) AS {_A}) AS total_spend_allocated FROM v1 GROUP BY ALL)""")
oracle("engagement_measures", f"""
SELECT {_FAMILY.format('ide')} AS editor_family, o AS org_login, CAST(sum(i) AS BIGINT) AS interactions,
       CAST(sum(g) AS BIGINT) AS code_generations, CAST(sum(a) AS BIGINT) AS code_acceptances,
       {_div('sum(a)', 'sum(g)')} AS acceptance_rate, count(DISTINCT uk) AS active_users_activity,
       CAST(sum(added) AS BIGINT) AS lines_added, CAST(sum(deleted) AS BIGINT) AS lines_deleted
FROM fide GROUP BY ALL""")
oracle("distinct_users_window", f"SELECT count(DISTINCT uk) AS users FROM v2 WHERE {_W}")
oracle("distinct_users_by_org", "SELECT org_login, year_month, count(DISTINCT uk) AS users FROM v2 GROUP BY ALL")
oracle("distinct_users_active", f"""
SELECT o AS org_login, count(DISTINCT uk) AS users FROM fide WHERE {_W.replace('usage_date', 'd')} GROUP BY ALL""")
oracle("orders_distinct_users", "SELECT o AS org_login, count(DISTINCT uk) AS users FROM ofp GROUP BY ALL")
oracle("seat_measures", f"""
SELECT count(*) AS idle_seats, CAST(sum(net_amount_30d) AS {_T}) AS idle_seat_spend_30d FROM idle""")
oracle("freshness_measures", f"""
SELECT 'Data through ' || strftime(max(d), '%Y-%m-%d') AS data_freshness,
       CAST(date_diff('day', max(d), DATE '2024-01-31') AS INTEGER) AS days_since_refresh,
       '{_DISCLAIMER}' AS attribution_disclaimer FROM fp""")


def _over_time(facts: str, by: str = "") -> str:
    g = f"{by}, " if by else ""
    on = f"s.{by} = x.{by} AND " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""
SELECT {g}usage_date, CAST(spend AS {_T}) AS spend,
       CAST(sum(spend) OVER (PARTITION BY {g}strftime(usage_date, '%Y-%m') ORDER BY usage_date) AS {_T}) AS spend_mtd,
       CAST(last_month AS {_T}) AS spend_last_month,
       CAST(sum(spend) OVER ({part}ORDER BY usage_date ROWS 29 PRECEDING) AS {_T}) AS spend_rolling_30d,
       CAST(CAST(sum(spend) OVER ({part}ORDER BY usage_date ROWS 29 PRECEDING) AS {_T}) AS DOUBLE) / 30 * 30.4 AS run_rate_monthly
FROM (SELECT {'s.' + by + ', ' if by else ''}s.d AS usage_date, coalesce(x.spend, 0) AS spend, y.spend AS last_month
      FROM (SELECT {g}CAST(unnest(generate_series(CAST(min(d) AS TIMESTAMP), (SELECT CAST(max(d) AS TIMESTAMP) FROM {facts}), INTERVAL 1 DAY)) AS DATE) AS d
            FROM {facts} {'GROUP BY ' + by if by else ''}) s
      LEFT JOIN (SELECT {g}d, sum(net) AS spend FROM {facts} GROUP BY ALL) x ON {on}s.d = x.d
      LEFT JOIN (SELECT {g}d, sum(net) AS spend FROM {facts} GROUP BY ALL) y
             ON {on.replace('x.', 'y.')}CAST(s.d - INTERVAL 1 MONTH AS DATE) = y.d)"""


def _mom(facts: str, by: str = "") -> str:
    g = f"{by}, " if by else ""
    on = f"s.{by} = x.{by} AND " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""
SELECT *, {_div('spend - spend_last_month', 'spend_last_month')} AS spend_mom_pct
FROM (SELECT {g}year_month, spend, lag(spend) OVER ({part}ORDER BY year_month) AS spend_last_month
      FROM (SELECT {'s.' + by + ', ' if by else ''}strftime(s.m, '%Y-%m') AS year_month, CAST(coalesce(x.spend, 0) AS {_T}) AS spend
            FROM (SELECT {g}unnest(generate_series(CAST(date_trunc('month', min(d)) AS TIMESTAMP), (SELECT CAST(max(d) AS TIMESTAMP) FROM {facts}), INTERVAL 1 MONTH)) AS m
                  FROM {facts} {'GROUP BY ' + by if by else ''}) s
            LEFT JOIN (SELECT {g}strftime(d, '%Y-%m') AS ym, sum(net) AS spend FROM {facts} GROUP BY ALL) x
                   ON {on}strftime(s.m, '%Y-%m') = x.ym))"""


oracle("orders_spend_over_time", _over_time("ofp"))
oracle("orders_spend_over_time_by_org", _over_time("ofp", "o").replace("SELECT o, usage_date", "SELECT o AS org_login, usage_date"))
oracle("orders_month_over_month", _mom("ofp"))
oracle("orders_month_over_month_by_org", f"SELECT * RENAME (o AS org_login) FROM ({_mom('ofp', 'o')})")

# ------------------------------------------------------------------ report pages

for _col in ("usage_date", "model_name", "cost_center"):
    oracle(f"spend_by_{_col}", f"SELECT {_col}, CAST(sum(net_amount) AS {_T}) AS total_spend FROM v2 GROUP BY ALL")
oracle("kpi_cards", f"""
SELECT CAST(sum(net_amount) AS {_T}) AS total_spend, count(DISTINCT user_login) AS active_users,
       {_div('sum(net_amount)', 'count(DISTINCT user_login)')} AS spend_per_active_user,
       (SELECT CAST(CAST(sum(net) AS {_T}) AS DOUBLE) / 30 * 30.4 FROM fp WHERE d > (SELECT max(d) - 30 FROM fp)) AS run_rate_monthly
FROM v2""")
oracle("user_table", f"""
SELECT user_login, team_name, CAST(sum(net_amount) AS {_T}) AS total_spend, CAST(sum(quantity) AS {_T}) AS premium_requests,
       {_div('sum(net_amount)', 'sum(quantity)')} AS cost_per_premium_request
FROM v2 WHERE year_month = '2024-01' AND cost_center = 'cc0' AND model_name = 'model-1' GROUP BY ALL""")


def _matrix(rows: str, where: str = "") -> str:
    return f"""
SELECT model_name, editor_family, feature, level, total_spend_allocated, allocated_requests,
       {_div('total_spend_allocated', 'sum(total_spend_allocated) OVER (PARTITION BY level, model_name, feature)')} AS editor_share_pct
FROM (SELECT model_name, editor_family, feature,
             CAST(3 - grouping(model_name) - grouping(editor_family) - grouping(feature) AS INTEGER) AS level,
             CAST(sum(allocated_net_amount) AS {_A}) AS total_spend_allocated,
             CAST(sum(allocated_quantity) AS {_A}) AS allocated_requests
      FROM {rows} {where} GROUP BY ROLLUP (model_name, editor_family, feature))"""


oracle("detail_matrix", _matrix("v1"))
oracle("detail_matrix_of_user", _matrix("v1", "WHERE uk = 'user1'"))
oracle("detail_cards", f"""
SELECT (SELECT CAST(sum(net) AS {_T}) FROM fp WHERE uk = 'user1') AS total_spend,
       {_div(_UN, 'sum(allocated_net_amount)')} AS unallocated_pct,
       {_div(_EQ, 'sum(allocated_net_amount)')} AS equal_split_fallback_pct,
       '{_DISCLAIMER}' AS attribution_disclaimer FROM v1 WHERE uk = 'user1'""")
oracle("idle_seat_table", "SELECT user_login, days_since_activity, net_amount_30d FROM idle")
oracle("acceptance_by_editor_family", f"""
SELECT {_FAMILY.format('ide')} AS editor_family, {_div('sum(a)', 'sum(g)')} AS acceptance_rate FROM fide GROUP BY ALL""")
oracle("interactions_by_feature_group", f"""
SELECT {_GROUP.format('feature')} AS feature_group, CAST(sum(i) AS BIGINT) AS interactions FROM fmf GROUP BY ALL""")
oracle("date_model", f"""
SELECT c.date, strftime(c.date, '%Y-%m') AS year_month, a.spend_exact, b.spend_allocated, e.editor_interactions, m.feature_interactions
FROM (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', min(d)) AS TIMESTAMP), CAST(last_day(max(d)) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM ev) c
LEFT JOIN (SELECT usage_date, CAST(sum(net_amount) AS {_T}) AS spend_exact FROM v2 GROUP BY ALL) a ON a.usage_date = c.date
LEFT JOIN (SELECT usage_date, CAST(sum(allocated_net_amount) AS {_A}) AS spend_allocated FROM v1 GROUP BY ALL) b ON b.usage_date = c.date
LEFT JOIN (SELECT d, CAST(sum(i) AS BIGINT) AS editor_interactions FROM fide GROUP BY d) e ON e.d = c.date
LEFT JOIN (SELECT d, CAST(sum(i) AS BIGINT) AS feature_interactions FROM fmf GROUP BY d) m ON m.d = c.date""")

# ------------------------------------------------------------------ quality

oracle("reconcile", """
SELECT (SELECT count(*) FROM ud) AS rows_user_day, (SELECT count(*) FROM ide) AS rows_user_ide,
       (SELECT count(*) FROM mf) AS rows_model_feature, (SELECT count(*) FROM seats) AS rows_seats,
       (SELECT count(*) FROM prem) AS rows_premium_requests, (SELECT count(*) FROM prem WHERE k = 42) AS orphaned_billing,
       (SELECT count(*) FROM ide WHERE ide = '' OR lower(login) NOT IN (SELECT uk FROM dim_user)) AS orphaned_user_ide,
       (SELECT count(*) FROM mf WHERE lower(login) NOT IN (SELECT uk FROM dim_user)) AS orphaned_user_model_feature""")


def _contract(record_type: str, counted: str, absent: dict[str, str], fields: str) -> str:
    rows = []
    for field in fields.split():
        present = f"({absent[field]})" if field in absent else f"({counted})"
        rows.append(
            f"SELECT '{record_type}' AS record_type, '{field}' AS field, ({counted}) AS records, {present} AS present, "
            f"({counted}) - {present} AS missing"
        )
    return "\nUNION ALL ".join(rows)


PARTS["days"] = """
SELECT d, login, o, bool_or(ev_ide) AS has_ide, bool_or(ev_mf) AS has_mf FROM (
  SELECT d, u AS login, o, event_type IN ('click', 'view') AND k <> 98 AS ev_ide, event_type IN ('view', 'error') AS ev_mf
  FROM ev WHERE user_id % 37 <> 36) GROUP BY ALL"""
PARTS["ide_entries"] = "SELECT DISTINCT d, login, o, ide FROM ide WHERE user_id % 37 <> 36 AND k <> 98"
PARTS["mf_entries"] = "SELECT DISTINCT d, login, o, model, feature FROM mf WHERE user_id % 37 <> 36"
PARTS["bills"] = "SELECT DISTINCT d, login, o FROM prem WHERE d >= DATE '2024-01-08'"
PARTS["items"] = "SELECT DISTINCT d, login, o, product, sku, model FROM prem WHERE d >= DATE '2024-01-08'"
oracle("payload_contract", "\nUNION ALL ".join((
    _contract("user_metrics", "SELECT count(*) FROM days",
              {"totals_by_ide": "SELECT count(*) FROM days WHERE has_ide",
               "totals_by_model_feature": "SELECT count(*) FROM days WHERE has_mf"},
              "day user_id user_login ai_credits_used user_initiated_interaction_count code_generation_activity_count "
              "code_acceptance_activity_count loc_added_sum totals_by_ide totals_by_model_feature ai_adoption_phase"),
    _contract("totals_by_ide[]", "SELECT count(*) FROM ide_entries", {},
              "ide user_initiated_interaction_count code_generation_activity_count"),
    _contract("totals_by_model_feature[]", "SELECT count(*) FROM mf_entries", {},
              "model feature user_initiated_interaction_count"),
    _contract("user_teams", "SELECT count(*) FROM teams", {}, "user_id user_login day team_id slug"),
    _contract("premium_request_usage", "SELECT count(*) FROM bills", {}, "usageItems"),
    _contract("usageItems[]", "SELECT count(*) FROM items",
              {"netAmount": "SELECT count(*) FROM items WHERE sku = 'sku1'"},
              "product sku model netAmount grossAmount netQuantity"),
    _contract("seats", "SELECT count(*) FROM seats", {}, "assignee"),
)))
oracle("observed_values", """
SELECT 'ide' AS dimension, CASE WHEN length(login) % 2 = 0 THEN ' ' || upper(ide) || chr(9) ELSE ide END AS value, count(*) AS entries
FROM ide_entries GROUP BY ALL
UNION ALL SELECT 'model', upper(model), count(*) FROM mf_entries GROUP BY ALL
UNION ALL SELECT 'feature', feature, count(*) FROM mf_entries GROUP BY ALL""")
oracle("cross_product_published", """
SELECT o AS org, o = 'org1' AND count(*) FILTER (login IN (SELECT login FROM ide_entries)) > 0 AS cross_product FROM ud GROUP BY o""")
oracle("seats_by_org", """
SELECT o AS org_login, count(*) AS seats, count(*) FILTER (login <> '') AS usable FROM seats GROUP BY o""")
oracle("billing_plan", """
SELECT o AS org_login, login AS user_login, CAST(unnest(generate_series(TIMESTAMP '2024-01-28', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS usage_date
FROM (SELECT o, login, row_number() OVER (PARTITION BY o ORDER BY login) AS n FROM seats) WHERE n <= 20""")
oracle("billing_plan_all", """
SELECT o AS org_login, login AS user_login, CAST(unnest(generate_series(TIMESTAMP '2024-01-28', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS usage_date
FROM (SELECT DISTINCT o, login FROM seats)""")
oracle("billing_plan_left_out", """
SELECT o AS org_login, count(*) AS users, greatest(count(*) - 20, 0) AS left_out FROM (SELECT DISTINCT o, login FROM seats) GROUP BY o""")
oracle("billing_orphans", f"""
SELECT d AS usage_date, o AS org_login, 'dim_product' AS missing, count(*) AS rows, CAST(sum(net) AS {_T}) AS net_amount
FROM prem WHERE k = 42 GROUP BY ALL""")
oracle("refused_values", """
SELECT CAST(k % 15 AS INTEGER) AS "case",
       CAST(sum(CASE k % 5 WHEN 1 THEN 3000000000 WHEN 3 THEN k ELSE 0 END) AS BIGINT) AS total,
       count(*) FILTER (k % 5 IN (0, 2)) AS counts_refused, count(*) FILTER (k % 3 = 2) AS days,
       count(*) FILTER (k % 3 <> 2) AS days_refused
FROM ev GROUP BY 1""")
oracle("seat_guard", "SELECT DISTINCT o AS org_login FROM seats WHERE o = 'org1'")
oracle("replace_window_withdrawn_day", """
SELECT d AS usage_date, count(*) AS rows, 'fact_premium_requests' AS fact FROM fp
WHERE d BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' AND day(d) % 3 <> 0 GROUP BY d
UNION ALL
SELECT d, count(DISTINCT (login, o)), 'fact_user_day' FROM ud
WHERE d BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' AND day(d) % 3 <> 0 GROUP BY d""")
oracle("constraint_violations", """
SELECT 'duplicate fact_premium_requests' AS rule, CAST(0 AS BIGINT) AS rows FROM fp HAVING count(*) >= 0
UNION ALL SELECT 'duplicates when a day comes twice', count(*) FROM fp WHERE d = DATE '2024-01-05'
UNION ALL SELECT 'ide_share range', count(*) FROM share WHERE share < 0 OR share > 1
UNION ALL SELECT 'dangling users of fact_user_ide_day', count(*) FROM fide WHERE uk NOT IN (SELECT uk FROM dim_user)
UNION ALL SELECT 'dangling users of staged user_ide', count(*) FROM ide WHERE lower(login) NOT IN (SELECT uk FROM dim_user)
UNION ALL SELECT 'duplicate staged user_day', count(*) FROM (SELECT 1 FROM ud GROUP BY d, lower(login), o HAVING count(*) > 1)""")
oracle("allocation_drift", f"""
SELECT usage_date, CAST(sum(allocated) AS {_A}) AS allocated, CAST(sum(net) AS {_T}) AS exact,
       CAST(sum(abs(net - allocated)) AS {_A}) AS drift
FROM (SELECT f.d AS usage_date, CAST(f.net AS {_T}) AS net, CAST(x.allocated AS {_A}) AS allocated
      FROM fp f JOIN (SELECT usage_date, uk, org_login, model_name, product, sku, sum(allocated_net_amount) AS allocated
                      FROM v1 GROUP BY ALL) x
      ON x.usage_date = f.d AND x.uk = f.uk AND x.org_login = f.o AND x.model_name = f.model
         AND x.product = f.product AND x.sku = f.sku)
GROUP BY usage_date""")

# ------------------------------------------------------------------ governance

_MANAGER = "(cost_center IN ('cc1', 'cc3') OR uk = 'user2')"
oracle("restrict", f"SELECT user_login, cost_center FROM dim_user WHERE {_MANAGER}")
oracle("restrict_everything", "SELECT user_login, cost_center FROM dim_user")
oracle("restricted_spend", f"SELECT user_login, CAST(sum(net_amount) AS {_T}) AS spend FROM v2 WHERE {_MANAGER} GROUP BY ALL")
for _name in ("summary", "user_exact_total", "user_breakdown", "editor_spend", "detail_matrix", "kpi_cards"):
    restricted_oracle(f"restricted_{_name}", RAW[_name], _MANAGER)
restricted_oracle("restricted_distinct_users", "SELECT count(DISTINCT uk) AS users FROM fp", _MANAGER)
oracle("restrict_report", f"""
SELECT user_login, CAST(sum(net_amount) AS {_T}) AS spend FROM v2 WHERE cost_center = 'cc2' GROUP BY ALL""")
oracle("erasure_preview", """
SELECT (SELECT count(*) FROM fp WHERE uk = 'user1') AS billing_rows,
       (SELECT count(DISTINCT (d, o)) FROM ud WHERE login = 'user1') AS activity_rows,
       (SELECT count(*) FROM fide WHERE uk = 'user1') AS ide_rows""")
oracle("erased_users", """
SELECT CASE WHEN uk = 'user1' THEN 'erased' ELSE user_login END AS user_login,
       CASE WHEN uk <> 'user1' THEN team_name END AS team_name, CASE WHEN uk <> 'user1' THEN cost_center END AS cost_center,
       CASE WHEN uk <> 'user1' THEN editor END AS last_activity_editor, plan_type, uk <> 'user1' AS is_active FROM dim_user""")
oracle("purge_preview", """
SELECT DATE '2024-01-11' AS cutoff_date, (SELECT count(DISTINCT (d, login, o)) FROM ud WHERE d < DATE '2024-01-11') AS activity_rows,
       (SELECT count(*) FROM fide WHERE d < DATE '2024-01-11') AS ide_rows, (SELECT count(*) FROM fp WHERE d < DATE '2024-01-11') AS billing_rows""")
oracle("restricted_billing_orphans", f"""
SELECT d AS usage_date, login AS user_login, 'dim_product' AS missing, count(*) AS rows FROM prem
WHERE k = 42 AND lower(login) IN (SELECT uk FROM dim_user WHERE {_MANAGER}) GROUP BY ALL""")
_GONE = "coalesce((SELECT min(lower(login)) FROM prem WHERE k = 42), 'user1')"
for _name, _days in (("erased_rows", "true"), ("purged_rows", "d >= DATE '2024-01-11'")):
    _BILLED = f"SELECT DISTINCT d, lower(login) AS uk, o, model, product, sku FROM prem WHERE k <> 42 AND {_days}"
    oracle(_name, f"""
SELECT 'billing_orphans' AS "table", count(*) AS rows FROM prem WHERE k = 42 AND lower(login) <> {_GONE} AND {_days}
UNION ALL SELECT 'fact_premium_requests', count(*) FROM ({_BILLED}) WHERE uk <> {_GONE}
UNION ALL SELECT 'fact_spend_shares', count(*) FROM ({_BILLED}) WHERE uk <> {_GONE}
UNION ALL SELECT 'fact_user_day', count(*) FROM (SELECT DISTINCT d, login, o FROM ud) WHERE login <> {_GONE} AND {_days}""")
oracle("pseudonymise", """
SELECT 'user-' || substr(sha256(user_login), 1, 8) AS user_login, 'present' AS net_amount, count(*) AS rows FROM v2 GROUP BY ALL""")

# ------------------------------------------------------------------ streaming

oracle("stream_ingest", f"""
SELECT d AS usage_date, count(*) AS rows, CAST(sum(net) AS {_T}) AS net_amount
FROM (SELECT d, lower(login) AS uk, o, model, product, sku, sum(net * CASE WHEN d < DATE '2024-01-08' THEN 2 ELSE 1 END) AS net
      FROM prem GROUP BY ALL) GROUP BY d""")
ORACLES["stream_ingest_many_batches"] = ORACLES["stream_ingest"]
oracle("stream_daily_activity", f"""
SELECT d AS activity_date, user_id, count(*) AS events, CAST(sum(value) AS {_T}) AS value FROM ev GROUP BY d, user_id""")

# ------------------------------------------------------------------ orders domain

oracle("orders_spend_by_user_model_editor", """
SELECT usage_date, user_login, org_login, model_name, product, sku, editor_name, feature, weight_basis,
       allocated_net_amount, allocated_quantity FROM ov1""")
oracle("orders_editor_spend", f"""
SELECT editor_family, feature, CAST(sum(allocated_net_amount) AS {_A}) AS spend FROM ov1 GROUP BY ALL
HAVING sum(allocated_net_amount) > 0""")
oracle("orders_detail_matrix", _matrix("ov1"))
oracle("orders_top_spenders", f"""
SELECT f.u AS user_login, c_mktsegment AS team_name, CAST(NULL AS VARCHAR) AS cost_center, CAST(sum(f.net) AS {_T}) AS spend
FROM ofp f JOIN customer ON c_custkey = f.user_id GROUP BY ALL ORDER BY spend DESC, user_login LIMIT 100""")
oracle("orders_monthly_spend_by_team", f"""
SELECT strftime(f.d, '%Y-%m') AS year_month, c_mktsegment AS cost_center, f.o AS org_login, f.model AS model_name,
       count(DISTINCT f.uk) AS active_users, CAST(sum(f.net) AS {_T}) AS net_amount
FROM ofp f JOIN customer ON c_custkey = f.user_id GROUP BY ALL""")

# ------------------------------------------------------------------ the questions as SQL functions

oracle("sql_top_spenders", RAW["top_spenders"].replace("LIMIT 25", "LIMIT 10"))
for _name in ("user_exact_total", "team_breakdown", "team_total", "orders_top_spenders"):
    ORACLES[f"sql_{_name}"] = ORACLES[_name]
