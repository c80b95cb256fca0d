"""Independent DuckDB SQL for the role views (the oracle side of ``oracle_sql()``).

Each constant is a ``name AS (...)`` CTE over the pre-registered driver views.
"""

M = """m AS (SELECT c_custkey AS machine_id, c_mktsegment AS model, c_nationkey AS line,
                c_name AS location FROM customer)"""

T = """t AS (SELECT o_orderkey AS ticket_id, o_custkey AS machine_id, o_orderdate AS opened_at,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'high'
              WHEN '3-MEDIUM' THEN 'medium' ELSE 'low' END AS priority,
         CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'P' THEN 'in_progress'
              WHEN 'F' THEN 'resolved' END AS status,
         o_orderpriority AS description
       FROM orders)"""

WO = """wo AS (SELECT o_orderkey AS work_order_id, o_custkey AS machine_id,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'high'
              WHEN '3-MEDIUM' THEN 'medium' ELSE 'low' END AS priority,
         'order ' || CAST(o_orderkey AS VARCHAR) AS title,
         o_orderpriority AS description,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ''
              ELSE 'tech-' || substr(o_orderpriority, 1, 1) END AS assigned_to,
         CAST(CAST(o_orderdate AS DATE) + 30 AS TIMESTAMP) AS due_date,
         CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'P' THEN 'in_progress'
              WHEN 'F' THEN 'closed' END AS status,
         o_orderdate AS created_at
       FROM orders)"""

A = """a AS (SELECT l_orderkey AS ticket_id, l_linenumber AS line_no, l_extendedprice AS amount,
         CASE l_returnflag WHEN 'R' THEN 'corrective' WHEN 'A' THEN 'preventive'
              WHEN 'N' THEN 'inspection' END AS action_type,
         'part ' || CAST(l_partkey AS VARCHAR) AS description,
         'tech-' || CAST(l_suppkey AS VARCHAR) AS performed_by,
         l_shipdate AS performed_at,
         CASE l_linestatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'in_progress' END AS status,
         CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS completed_at
       FROM lineitem)"""

AM = """am AS (SELECT a.*, o.o_custkey AS machine_id FROM a JOIN orders o
                ON o.o_orderkey = a.ticket_id)"""

R = """r AS (SELECT event_id AS reading_id, user_id AS machine_id, ts, value AS vibration,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS temperature FROM events)"""

QC = """qc AS (SELECT event_id AS check_id, event_id AS order_id,
          user_id AS machine_id, event_type AS check_type,
          CASE WHEN value > 50 THEN 'fail' ELSE 'pass' END AS result,
          CASE WHEN value > 50 THEN 'VIB-' || CAST(user_id AS VARCHAR) END AS defect_code,
          props AS notes, 'qa-' || event_type AS inspector,
          ts AS checked_at FROM events)"""

N = """n AS (SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_extendedprice AS amount,
         l_partkey AS machine_id,
         CASE l_returnflag WHEN 'R' THEN 'alert' WHEN 'A' THEN 'handoff'
              WHEN 'N' THEN 'observation' END AS note_type,
         'qty ' || CAST(l_quantity AS VARCHAR) AS content,
         'op-' || CAST(l_suppkey AS VARCHAR) AS created_by, l_shipdate AS created_at
       FROM lineitem)"""

LOG = """log AS (SELECT user_id AS entity_id, value, props,
           CASE event_type WHEN 'signup' THEN 'insert' WHEN 'view' THEN 'update_preimage'
                WHEN 'click' THEN 'update_postimage' WHEN 'purchase' THEN 'update_postimage'
                WHEN 'error' THEN 'delete' END AS _change_type,
           event_id AS _commit_version, ts AS _commit_timestamp FROM events)"""

NEWEST = """newest AS (SELECT ticket_id, performed_by, status FROM a WHERE ticket_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY ticket_id
        ORDER BY performed_at DESC NULLS FIRST, line_no DESC, amount DESC) = 1)"""

AH = """ah AS (SELECT user_id AS action_id, event_id AS ticket_id, user_id AS machine_id,
          'tech-' || event_type AS performed_by, event_type AS action_type,
          props AS description,
          CASE WHEN value > 25 THEN 'completed' ELSE 'in_progress' END AS status,
          CASE WHEN value > 25 THEN ts END AS completed_at,
          CASE event_type WHEN 'signup' THEN 'insert' WHEN 'view' THEN 'update_preimage'
               WHEN 'click' THEN 'update_postimage' WHEN 'purchase' THEN 'update_postimage'
               WHEN 'error' THEN 'delete' END AS _change_type,
          event_id AS _commit_version FROM events)"""

OH = """oh AS (SELECT o_orderkey AS order_id, o_totalprice AS total,
          CASE o_orderstatus WHEN 'O' THEN 'insert' WHEN 'P' THEN 'update_postimage'
               ELSE 'delete' END AS _change_type,
          o_orderkey AS _commit_version, o_orderdate AS _commit_timestamp FROM orders)"""

SNAP = """o_all AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
             o_orderpriority FROM orders),
old_s AS (SELECT * FROM o_all WHERE o_orderpriority <> '5-LOW'),
new_s AS (SELECT o_orderkey, o_custkey,
             CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'F' ELSE o_orderstatus END
               AS o_orderstatus,
             o_totalprice, o_orderdate, o_orderpriority
          FROM o_all WHERE o_orderpriority <> '4-NOT SPECIFIED')"""


def with_(*ctes: str) -> str:
    """A WITH clause of the given CTEs."""
    return "WITH " + ",\n".join(ctes) + "\n"
