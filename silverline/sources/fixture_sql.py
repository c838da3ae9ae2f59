"""The bronze derivation of ``fixtures.py`` written as plain SQL text.

This is the independent oracle side: DuckDB runs it over the raw test
tables (``customer supplier orders lineitem events``) and the model SQL of
``silverline.plans.oracle`` reads the CTEs it defines
(``hfj_resource hfj_res_ver hfj_res_link hfj_spidx_token``).

The rules are the ones written down in FIXTURES.md section 2; the Spark
version in ``fixtures.py`` is written separately with DataFrame functions.
"""

from __future__ import annotations

# One row per base resource: id, type, publish time and JSON body (text).
_BASE = r"""
base AS (
    SELECT 1000000000 + c_custkey AS res_id, 'Patient' AS res_type,
           TIMESTAMP '2023-01-01 00:00:00' AS published,
           '{"resourceType":"Patient","name":"' || c_name || '"}' AS body
    FROM customer
    UNION ALL
    SELECT 2000000000 + s_suppkey, 'Organization', TIMESTAMP '2023-01-01 00:00:00',
           '{"resourceType":"Organization"'
           || CASE WHEN s_suppkey % 10 = 9 THEN ''
                   ELSE ',"name":"PKM ' || CAST(s_suppkey % 40 AS VARCHAR) || '"' END
           || '}'
    FROM supplier
    UNION ALL
    SELECT 3000000000 + o_orderkey, 'Encounter', o_orderdate,
           CASE WHEN o_orderkey % 41 = 0 THEN 'not json'
                ELSE '{"resourceType":"Encounter","status":"'
                     || CASE o_orderstatus WHEN 'F' THEN 'finished'
                                           WHEN 'O' THEN 'in-progress'
                                           ELSE 'planned' END
                     || '","class":{"code":"'
                     || CASE WHEN o_orderkey % 4 = 0 THEN 'EMER' ELSE 'AMB' END
                     || '"},"subject":{"reference":"Patient/' || CAST(o_custkey AS VARCHAR) || '"}}'
           END
    FROM orders
    UNION ALL
    SELECT 4000000000 + o_orderkey, 'Condition', o_orderdate,
           '{"resourceType":"Condition","subject":{"reference":"Patient/' || CAST(o_custkey AS VARCHAR)
           || '"},"clinicalStatus":{"coding":[{"code":"active"}]}'
           || CASE substr(o_orderpriority, 1, 1)
                WHEN '1' THEN ',"code":{"coding":[{"code":"I10","display":"Essential hypertension"}]}'
                WHEN '2' THEN ',"code":{"coding":[{"code":"E11.9","display":"Type 2 diabetes"}]}'
                WHEN '3' THEN ',"code":{"coding":[{"code":"J06.9","display":"Acute URI"}]}'
                WHEN '5' THEN ',"code":{"coding":[{"code":"I11.9","display":"Hypertensive heart disease"}]}'
                ELSE '' END
           || '}'
    FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL
    SELECT 5000000000 + event_id, 'Observation', ts,
           '{"resourceType":"Observation"'
           || CASE WHEN event_id % 31 = 0 THEN ''
                   ELSE ',"subject":{"reference":"Patient/' || CAST(user_id AS VARCHAR) || '"}' END
           || ',"encounter":{"reference":"Encounter/' || CAST(event_id AS VARCHAR) || '"}'
           || CASE WHEN event_id % 47 = 0 THEN ',"note":"a","note":"b"' ELSE '' END
           || CASE WHEN event_type = 'signup' THEN ''
                   WHEN event_id % 59 = 0 THEN ',"effectiveDateTime":"10:00:00"'
                   WHEN event_id % 61 = 0 THEN ',"effectiveDateTime":"'
                        || CASE (event_id // 61) % 5
                             WHEN 0 THEN strftime(ts, '%Y/%m/%d') WHEN 1 THEN strftime(ts, '%Y%m%d')
                             WHEN 2 THEN strftime(ts, '%Y%m%dT%H%M%SZ') WHEN 3 THEN strftime(ts, '%d %b %Y')
                             ELSE CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) END || '"'
                   ELSE ',"effectiveDateTime":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+07:00"' END
           || ',"code":{"coding":[{"code":"'
           || CASE WHEN event_type = 'purchase' THEN '29463-7' ELSE '8480-6' END
           || '","display":"'
           || CASE WHEN event_type = 'purchase' THEN 'Body weight'
                   WHEN event_id % 2 = 0 THEN 'Systolic blood pressure'
                   ELSE 'Diastolic blood pressure' END
           || '"}]},"valueQuantity":{"value":'
           || CASE WHEN event_id % 43 = 0
                        THEN CAST(100 + CAST(floor(value) AS BIGINT) % 60 AS VARCHAR) || '.50'
                   WHEN event_type = 'error' AND event_id % 3 = 0 THEN '0'
                   WHEN event_type = 'error' AND event_id % 3 = 1 THEN '"n/a"'
                   WHEN event_id % 2 = 0 THEN CAST(100 + CAST(floor(value) AS BIGINT) % 60 AS VARCHAR)
                   ELSE CAST(60 + CAST(floor(value) AS BIGINT) % 45 AS VARCHAR) END
           || ',"unit":"mmHg"}}'
    FROM events
    UNION ALL
    SELECT 6000000000 + o_orderkey, 'CarePlan', o_orderdate,
           '{"resourceType":"CarePlan","status":"active","category":[{"coding":[{"display":"'
           || CASE WHEN o_orderkey % 2 = 0 THEN 'Weight faltering' ELSE 'Diet' END
           || '"}]}],"description":"d"}'
    FROM orders WHERE o_orderkey % 7 = 0
)"""

_VERSIONS = r"""
base_versions AS (
    SELECT b.*, v.ver, CASE WHEN b.res_id % 5 = 0 THEN 2 ELSE 1 END AS last_ver
    FROM base AS b
    JOIN (VALUES (1), (2)) AS v(ver) ON v.ver = 1 OR b.res_id % 5 = 0
)"""

_RESOURCE = r"""
hfj_resource AS (
    SELECT
        CAST(res_id AS BIGINT) AS res_id,
        'f' || CAST(res_id AS VARCHAR) AS fhir_id,
        res_type,
        CAST(ver AS BIGINT) AS res_ver,
        published AS res_published,
        published + to_days(CAST(ver - 1 AS INTEGER)) AS res_updated,
        CASE WHEN ver = last_ver AND res_id % 11 = 0 THEN published + INTERVAL 2 DAY
             ELSE TIMESTAMP '1970-01-01 00:00:00' END AS res_deleted_at,
        CAST(ver AS BIGINT) AS _peerdb_version,
        CAST(CASE WHEN ver = last_ver AND res_id % 13 = 0 THEN 1 ELSE 0 END AS INTEGER) AS _peerdb_is_deleted
    FROM base_versions
)"""

_RES_VER = r"""
hfj_res_ver AS (
    SELECT CAST(res_id AS BIGINT) AS res_id, CAST(ver AS BIGINT) AS res_ver, body AS res_text_vc,
           CAST(2 AS BIGINT) AS _peerdb_version,
           CAST(CASE WHEN res_id % 37 = 0 THEN 1 ELSE 0 END AS INTEGER) AS _peerdb_is_deleted
    FROM base_versions
    UNION ALL
    SELECT CAST(res_id AS BIGINT), CAST(ver AS BIGINT), '{"stale":true}',
           CAST(1 AS BIGINT), CAST(0 AS INTEGER)
    FROM base_versions
    WHERE res_id % 6 = 0 OR res_id % 37 = 0
)"""

_LINK = r"""
link_v1 AS (
    SELECT 'Encounter.subject' AS src_path, 'Encounter' AS source_resource_type,
           3000000000 + o_orderkey AS src_resource_id, 'Patient' AS target_resource_type,
           1000000000 + o_custkey AS target_resource_id, o_orderdate AS sp_updated,
           CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 9 = 0 THEN 1 ELSE 0 END AS has_v2,
           CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS v2_deleted
    FROM orders
    UNION ALL
    SELECT 'Encounter.serviceProvider', 'Encounter', 3000000000 + l_orderkey, 'Organization',
           2000000000 + min(l_suppkey), min(l_shipdate),
           CASE WHEN l_orderkey % 8 = 0 THEN 1 ELSE 0 END, 0
    FROM lineitem
    GROUP BY l_orderkey
    UNION ALL
    SELECT 'CarePlan.encounter', 'CarePlan', 6000000000 + o_orderkey, 'Encounter',
           3000000000 + o_orderkey, o_orderdate, 0, 0
    FROM orders WHERE o_orderkey % 7 = 0
),
hfj_res_link AS (
    SELECT src_path, source_resource_type, CAST(src_resource_id AS BIGINT) AS src_resource_id,
           target_resource_type, CAST(target_resource_id AS BIGINT) AS target_resource_id,
           sp_updated, CAST(1 AS BIGINT) AS _peerdb_version, CAST(0 AS INTEGER) AS _peerdb_is_deleted
    FROM link_v1
    UNION ALL
    SELECT src_path, source_resource_type, CAST(src_resource_id AS BIGINT),
           target_resource_type, CAST(target_resource_id AS BIGINT),
           sp_updated + INTERVAL 1 DAY, CAST(2 AS BIGINT), CAST(v2_deleted AS INTEGER)
    FROM link_v1 WHERE has_v2 = 1
)"""

_TOKEN = r"""
hfj_spidx_token AS (
    SELECT CAST(o_orderkey AS BIGINT) AS sp_id, 'Encounter' AS res_type, 'status' AS sp_name,
           o_orderstatus AS sp_value, CAST(1 AS BIGINT) AS _peerdb_version,
           CAST(0 AS INTEGER) AS _peerdb_is_deleted
    FROM orders
    UNION ALL
    SELECT CAST(o_orderkey AS BIGINT), 'Encounter', 'status', 'X', CAST(2 AS BIGINT),
           CAST(CASE WHEN o_orderkey % 19 = 0 THEN 1 ELSE 0 END AS INTEGER)
    FROM orders WHERE o_orderkey % 10 = 0 OR o_orderkey % 19 = 0
    UNION ALL
    SELECT CAST(100000000 + o_orderkey AS BIGINT), 'Condition', 'code', o_orderpriority,
           CAST(1 AS BIGINT), CAST(0 AS INTEGER)
    FROM orders
)"""

BRONZE_CTES = ",\n".join([_BASE, _VERSIONS, _RESOURCE, _RES_VER, _LINK, _TOKEN])


def with_bronze(*ctes: str) -> str:
    """``WITH <bronze ctes>, <extra ctes>`` prefix for an oracle query."""
    parts = [BRONZE_CTES, *ctes]
    return "WITH " + ",\n".join(p.strip("\n") for p in parts) + "\n"
