"""Stand-in entity tables over the given tables. One SQL text each, run by Spark and by the SQL check alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "v_events": """
        SELECT event_id AS uid, CAST(user_id AS BIGINT) AS device, event_type AS type, ts, value, props AS metadata,
          CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'purchase' THEN 'warning' ELSE 'info' END AS severity
        FROM {events}""",
    "v_devices": """
        SELECT c_custkey AS uid, c_name AS name, c_mktsegment AS type, CASE WHEN c_acctbal < 0 THEN 'offline' ELSE 'online' END AS status, c_nationkey AS organization
        FROM {customer}""",
    "v_recordings": """
        SELECT o_orderkey AS uid, o_custkey AS device, CASE o_orderstatus WHEN 'F' THEN 'ready' WHEN 'O' THEN 'processing' ELSE 'uploading' END AS status, o_orderdate AS started_at
        FROM {orders}""",
    "v_issues": """
        SELECT o_orderkey AS uid, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS status, o_orderpriority AS priority,
          CASE WHEN o_totalprice > 300000 THEN 'critical' WHEN o_totalprice > 150000 THEN 'major' ELSE 'minor' END AS severity,
          o_orderdate AS created_at, CASE WHEN o_orderstatus = 'F' AND last_ship >= o_orderdate THEN last_ship END AS closed_at,
          CASE WHEN o_custkey % 2 = 0 THEN 'customer' ELSE 'staff' END AS reporter_type, o_custkey AS sequence_uid, o_custkey % 7 AS problem_uid, o_orderkey % 5 AS tool_uid, o_orderkey % 997 AS object_uid
        FROM {orders} LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM {lineitem} GROUP BY l_orderkey) s ON o_orderkey = l_orderkey""",
    "v_boxes": """
        SELECT l_orderkey * 10 + l_linenumber AS uid, l_partkey AS item, l_suppkey AS annotator, l_linestatus AS task, l_quantity AS x0, l_tax * 100 AS y0, l_quantity + 10 + l_discount * 100 AS x1, l_tax * 100 + 20 AS y1
        FROM {lineitem}""",
    "v_edits": """
        SELECT CAST(l_partkey AS STRING) AS object_uuid, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_orderkey AS STRING) END AS dataset_item_uid,
          CASE WHEN l_linenumber % 3 = 1 THEN NULL ELSE CAST(l_suppkey AS STRING) END AS sequence_uid,
          CASE WHEN l_returnflag = 'R' THEN 'delete' WHEN l_quantity > 49 THEN 'patch' ELSE 'upsert' END AS action,
          CASE WHEN l_linenumber % 3 = 1 THEN 'cuboid' WHEN l_linenumber % 3 = 0 THEN 'cuboid 3d' WHEN l_discount > 0.08 THEN 'sphere' ELSE 'point cloud polyline' END AS object_type,
          CASE WHEN l_tax < 0.01 THEN NULL ELSE 'data' END AS object_data, CASE WHEN l_tax > 0.07 THEN '' ELSE l_linestatus END AS object_name,
          l_shipdate AS ts, l_orderkey AS k1, l_partkey AS k2, l_suppkey AS k3, l_linenumber AS k4, l_extendedprice AS k5
        FROM {lineitem}""",
    "v_items": """
        SELECT d.doc_id AS uid, source AS dataset, lang AS label, text, n_chars, quality, toxic, d.doc_id - d.doc_id % 5 AS related_sequence_uid,
          concat('data/', source, '/', CAST(d.doc_id AS STRING), CASE d.doc_id % 7 WHEN 0 THEN '.jpg' WHEN 1 THEN '.PNG' WHEN 2 THEN '.mp4' WHEN 3 THEN '.alp.gz' WHEN 4 THEN '.compressed.ply' WHEN 5 THEN '.pcd' ELSE '.mcap' END) AS key
        FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id""",
    "v_frames": """
        SELECT conv_id AS sequence_uid, turn AS frame_index, role AS camera, text, length(text) AS width, CASE WHEN turn % 11 = 10 THEN 720 ELSE 480 END AS height
        FROM {conversations}""",
    "v_states": "SELECT vec_id, CAST(label AS BIGINT) AS episode_index, embedding AS state FROM {embeddings}",
    "v_urls": "SELECT page_id, url FROM {pages}",
    "v_messages": """
        SELECT concat('/camera/', CAST(user_id % 5 AS STRING), '/image') AS topic,
          CASE event_type WHEN 'click' THEN 'sensor_msgs/msg/CompressedImage' WHEN 'view' THEN 'sensor_msgs/msg/Image' WHEN 'signup' THEN 'sensor_msgs/Image' WHEN 'error' THEN 'sensor_msgs/CompressedImage' ELSE 'std_msgs/msg/String' END AS msgtype,
          event_id * 1000000 AS log_time_ns, CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id END AS header_sec, CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id % 1000 END AS header_nanosec,
          CASE WHEN event_id % 3 = 0 THEN 'cam_frame' ELSE '' END AS frame_id,
          CASE event_id % 3 WHEN 0 THEN 'rgb8' WHEN 1 THEN '32FC1' ELSE 'MONO16' END AS encoding,
          CASE event_id % 4 WHEN 0 THEN 'jpeg' WHEN 1 THEN 'rgb8; PNG compressed' WHEN 2 THEN '16UC1; compressedDepth png' ELSE 'jpeg compressed bgr8' END AS format,
          props AS data, user_id AS recording, event_id
        FROM {events}""",
}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in entity table; NTZ times become instants once, here."""
    sql = VIEWS[name]
    df = spark.sql(sql, **{t: table(spark, sf_dir, t) for t in set(re.findall(r"\{(\w+)\}", sql))})
    return df.select([df[c].cast("timestamp").alias(c) if t == "timestamp_ntz" else df[c] for c, t in df.dtypes])


def oracle(sql: str) -> str:
    """SQL over views as one statement over the tables."""
    ctes, seen = [], set()
    for name in VIEWS:
        if re.search(rf"\b{name}\b", sql) and name not in seen:
            seen.add(name)
            body = re.sub(r"\{(\w+)\}", r"\1", VIEWS[name]).replace("AS STRING)", "AS VARCHAR)")
            ctes.append(f"{name} AS ({body})")
    body = sql.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {', '.join(ctes)}, {body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join(ctes)}, {body[5:]}"
    return f"WITH {', '.join(ctes)} {body}"
