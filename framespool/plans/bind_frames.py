"""Documents, normalisation, pose maths and streams on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import normalize as N
from ..functions import pose as Q
from ..functions.basic import micros
from ..functions.catalog import TOPICS, at_path
from ..sources import scans as S
from ..sources import sinks as K
from ..streaming import live as L
from .tables import Registry, rounded, table

R = Registry()


def documents_of_events(spark, d):
    """Each event as the time-stamp document of a clip: its user; the frame is its number."""
    us = micros("ts")
    stamp = lambda x: F.struct((x * 1000 / N.NANOS).cast("long").alias("sec"), F.pmod(x * 1000, F.lit(N.NANOS)).alias("nsec"))
    arm = F.struct(F.struct(F.when(F.col("event_id") % 3 > 0, stamp(us + F.col("event_id") % 100)).alias("measured_js_stamp")).alias("measured_data"))
    doc = F.struct(stamp(us).alias("image_left_stamp"), F.when(F.col("event_id") % 2 == 0, stamp(us + 7)).alias("image_right_stamp"), F.struct(arm.alias("ECM")).alias("Kinematics_set_1"))
    path = F.concat(F.lit("/data/online_set/"), "user_id", F.lit("/time_syn/"), "event_id", F.lit(".json"))
    return K.documents_of(table(spark, d, "events"), path, doc).select(F.col("rel_path").alias("path"), F.col("payload").alias("value"))


R.sql["s1_stamp_documents"] = """SELECT user_id::VARCHAR AS clip, event_id::INTEGER AS frame, epoch_us(ts) * 1000 AS image_left, CASE
WHEN event_id % 2 = 0 THEN (epoch_us(ts) + 7) * 1000 END AS image_right, NULL::BIGINT AS image_side,
CASE WHEN event_id % 3 > 0 THEN (epoch_us(ts) + event_id % 100) * 1000 END AS ecm__measured_js FROM events"""


@R.query
def s1_stamp_documents(spark, d):
    out = S.stamp_documents(documents_of_events(spark, d), {t: TOPICS[t] for t in ("image_right", "image_side", "ECM.measured_js")})
    return out.select("clip", "frame", "image_left", "image_right", "image_side", F.col("ECM__measured_js").alias("ecm__measured_js"))


@R.query
def s2_kinematic_documents(spark, d):
    v = lambda a, n: F.transform(F.slice("embedding", a, n), lambda x: x.cast("double"))
    js = F.struct(v(1, 6).alias("position"), v(7, 6).alias("velocity"))
    cp = F.struct(v(13, 3).alias("position"), F.when(F.col("vec_id") % 9 == 0, v(16, 3)).otherwise(v(16, 4)).alias("orientation"))
    jaw = F.struct(F.struct(v(20, 1).alias("position")).alias("measured_data"))
    arm = F.struct(F.struct(js.alias("measured_js"), cp.alias("measured_cp")).alias("measured_data"), F.when(F.col("vec_id") % 2 == 0, jaw).alias("jaw"))
    doc = F.array(F.struct(arm.alias("arm"), F.when(F.col("vec_id") % 2 > 0, jaw).alias("jaw")))
    path = F.concat(F.lit("/data/online_set/"), "label", F.lit("/kinematic/PSM1/"), "vec_id", F.lit(".json"))
    rows = K.documents_of(table(spark, d, "embeddings"), path, doc).select(F.col("rel_path").alias("path"), F.col("payload").alias("value"))
    out = S.kinematic_documents(rows)
    return rounded(out.select("clip", F.col("frame").cast("long").alias("frame"), "arm_name", F.element_at("measured_js.position", 6).alias("joint_6"), "jaw_position", "corrupt"))


R.sql["s2_kinematic_documents"] = """SELECT label::VARCHAR AS clip, vec_id AS frame, 'PSM1' AS arm_name, round(embedding[6]::DOUBLE, 6) AS joint_6, round(embedding[20]::DOUBLE,
6) AS jaw_position, CASE WHEN vec_id % 9 = 0 THEN 'orientation' END AS corrupt FROM embeddings"""
R.sql["s3_label_documents"] = """WITH x AS (SELECT doc_id AS frame, toxic FROM labels), y AS (SELECT doc_id AS frame, quality FROM labels WHERE doc_id % 2 = 0),
z AS (SELECT doc_id AS frame, lang FROM documents), w AS (SELECT vec_id AS frame, label FROM embeddings)
SELECT frame, toxic, quality, lang, label, (SELECT count(quality) > 0 AND count(quality) < greatest(count(toxic), count(quality), (SELECT count(lang)
FROM z), (SELECT count(label) FROM w)) FROM x FULL JOIN y USING (frame)) AS gesture_partial
FROM x FULL JOIN y USING (frame) FULL JOIN z USING (frame) FULL JOIN w USING (frame)"""


@R.query
def s3_label_documents(spark, d):
    labels = table(spark, d, "labels").withColumnRenamed("doc_id", "frame")
    phase = table(spark, d, "documents").select(F.col("doc_id").alias("frame"), "lang")
    step = table(spark, d, "embeddings").select(F.col("vec_id").alias("frame"), "label")
    return S.label_documents(labels.select("frame", "toxic"), labels.filter("frame % 2 = 0").select("frame", "quality"), phase, step, ["frame"])


R.sql["s4_calibrated_documents"] = """SELECT vec_id AS frame, 'PSM2' AS arm_name, CASE WHEN vec_id % 4 > 0 THEN round(embedding[2]::DOUBLE, 6) END AS y, vec_id % 2 > 0 AS has_setpoint
FROM embeddings"""


@R.query
def s4_calibrated_documents(spark, d):
    v = lambda a, n: F.transform(F.slice("embedding", a, n), lambda x: x.cast("double"))
    pose = lambda k: F.struct(v(1, 3).alias("position"), F.when(F.col("vec_id") % k > 0, v(4, 4)).alias("orientation"))
    doc = F.struct(F.lit("PSM2").alias("arm_name"), pose(4).alias("measured_cp_calibrated"), F.when(F.col("vec_id") % 2 > 0, pose(4)).alias("setpoint_cp_calibrated"))
    path = F.concat(F.lit("/data/online_set/"), "label", F.lit("/calibrated/PSM2/"), "vec_id", F.lit(".json"))
    rows = K.documents_of(table(spark, d, "embeddings"), path, doc).select(F.col("rel_path").alias("path"), F.col("payload").alias("value"))
    out = S.calibrated_documents(rows)
    return rounded(out.select(F.col("frame").cast("long").alias("frame"), "arm_name", F.col("measured.position")[1].alias("y"), F.col("setpoint").isNotNull().alias("has_setpoint")))


R.sql["s5_clip_metadata"] = """SELECT event_id, json_extract_string(props, '$.k') AS k, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END::INTEGER AS n_extra, CASE
WHEN event_id % 2 = 0 THEN event_type END AS extra_kind FROM events"""


@R.query
def s5_clip_metadata(spark, d):
    more = F.when(F.col("event_id") % 2 == 0, F.replace(F.col("props"), F.lit("}"), F.concat(F.lit(', "kind": "'), F.col("event_type"), F.lit('"}')))).otherwise(F.col("props"))
    out = S.clip_metadata(table(spark, d, "events").withColumn("value", more), ["k"])
    return out.select("event_id", "k", F.size("extra").alias("n_extra"), F.col("extra")["kind"].alias("extra_kind"))


R.sql["s6_calibrations"] = """SELECT p_partkey::VARCHAR AS clip, p_size AS width, (p_size * 2)::INTEGER AS height, p_retailprice AS fx, round(CASE
WHEN p_partkey % 3 = 0 THEN 0.5 ELSE 4.25 / p_retailprice END, 9) AS baseline FROM part"""


@R.query
def s6_calibrations(spark, d):
    text = F.concat(
        F.lit("image_width: "), "p_size", F.lit("\nimage_height: "), F.col("p_size") * 2, F.lit("\nP2: !!opencv-matrix\n   data: [ "), "p_retailprice",
        F.lit(", 0., 3.2e+02, -4.25, 0., 900.0, 2.4e+02, 0., 0., 0., 1., 0. ]"),
    )
    parts = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("clip"), text.alias("value"), "p_partkey")
    stereo = parts.filter("p_partkey % 3 = 0").select("clip", F.lit(0.5).alias("baseline"))
    return rounded(S.calibrations(parts, stereo).drop("text"), 9, fx=None)


R.sql["s7_camera_timetables"] = "SELECT user_id, event_id::INTEGER // 2 AS frame, max(epoch_us(ts)) * 1000 AS timestamp_ns FROM events GROUP BY ALL"


@R.query
def s7_camera_timetables(spark, d):
    entry = F.struct("event_id", F.struct(F.expr("event_id div 2").alias("frame"), (micros("ts") * 1000).alias("timestamp_ns")).alias("e"))
    # a clip's timetable comes in documents of a thousand frames, so none grows with the clip
    part = F.expr("event_id div 1000").alias("part")
    docs = table(spark, d, "events").groupBy("user_id", part).agg(F.to_json(F.transform(F.sort_array(F.collect_list(entry)), lambda x: x["e"])).alias("value"))
    return S.camera_timetables(docs, "user_id", order="part")


R.sql["s8_clip_inventory"] = """WITH p AS (SELECT 'online_' || regexp_extract(url, '://([^/?#]*)', 1) AS dataset, regexp_extract(url, '://[^/?#]*/([^/?#]*)', 1) AS clip, url
FROM pages)
SELECT dataset, clip, count(*) AS n_files, bool_or(regexp_matches(url, '\\?')) AS has_query, bool_or(regexp_matches(url, '#')) AS has_mark,
'online' AS variant FROM p GROUP BY dataset, clip"""


@R.query
def s8_clip_inventory(spark, d):
    dataset = F.concat(F.lit("online_"), F.regexp_extract("url", "://([^/?#]*)", 1))
    return S.clip_inventory(table(spark, d, "pages"), dataset, F.regexp_extract("url", "://[^/?#]*/([^/?#]*)", 1), {"has_query": r"\?", "has_mark": "#"}, path="url")


R.sql["s9_completed_frames"] = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"""


@R.query
def s9_completed_frames(spark, d):
    done = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return S.completed_only(table(spark, d, "lineitem"), done, "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


R.sql["s10_modality_sink"] = "SELECT event_type, event_id, user_id, round(value, 6) AS value FROM events"


@R.query
def s10_modality_sink(spark, d):
    path, df = K.shared_path(spark, "modalities"), table(spark, d, "events").select("event_type", "event_id", "user_id", "value")
    K.write_modalities({"timestamp": df.select("event_type", "event_id", "user_id"), "value": df.select("event_type", "event_id", "value")}, path, ["event_type"])
    back = [spark.read.parquet(f"{path}/{name}") for name in ("timestamp", "value")]
    return rounded(back[0].join(back[1], ["event_type", "event_id"]).select("event_type", "event_id", "user_id", "value"))


R.sql["s11_index_sink"] = """SELECT o_orderkey, o_orderstatus, o_orderstatus AS task, o_custkey FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderkey, o_orderstatus,
o_orderstatus, o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 2 = 0"""


@R.query
def s11_index_sink(spark, d):
    path, orders = K.shared_path(spark, "index"), table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    K.write_partitioned(orders, path, ["o_orderstatus"], {"o_orderstatus": "task"})
    K.write_partitioned(orders.filter("o_orderstatus = 'P' AND o_orderkey % 2 = 0"), path, ["o_orderstatus"], {"o_orderstatus": "task"}, mode="overwrite")
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "task", "o_custkey")


R.sql["s12_json_lines"] = """SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}' AS line FROM nation"""


@R.query
def s12_json_lines(spark, d):
    path = K.shared_path(spark, "lines")
    K.write_json_lines(table(spark, d, "nation").select("n_nationkey", "n_name"), path, ["n_nationkey"])
    return spark.read.text(path).select(F.col("value").alias("line"))


R.sql["s13_reemitted"] = """SELECT user_id::VARCHAR AS clip, event_id::INTEGER AS frame, event_type, CASE WHEN event_id % 4 > 0 THEN round(value, 6) END AS value FROM events"""


@R.query
def s13_reemitted(spark, d):
    payload = F.struct("event_type", F.struct(F.when(F.col("event_id") % 4 > 0, F.col("value")).alias("value")).alias("data"))
    path = F.concat(F.lit("set/"), "user_id", F.lit("/annotation/"), "event_id", F.lit(".json"))
    back = K.documents_of(table(spark, d, "events"), path, payload).withColumn("doc", F.from_json("payload", "event_type string, data struct<value:double>"))
    return rounded(back.select(*S.keys_of(F.col("rel_path"))[1:], "doc.event_type", "doc.data.value"))


R.sql["p1_catalog_paths"] = "SELECT event_id, json_extract_string(props, '$.k') AS k, NULL::VARCHAR AS absent FROM events"


@R.query
def p1_catalog_paths(spark, d):
    return table(spark, d, "events").select("event_id", at_path(F.col("props"), ("k",)).alias("k"), at_path(F.col("props"), ("k", "deeper")).alias("absent"))


R.sql["p2_stamps"] = "SELECT event_id, (epoch_us(ts) * 1000) // 1000000000 AS sec, (epoch_us(ts) * 1000) % 1000000000 AS nsec, epoch_us(ts) * 1000 AS ns FROM events"


@R.query
def p2_stamps(spark, d):
    sec, nsec = N.from_ns(micros("ts") * 1000)
    return table(spark, d, "events").select("event_id", sec.alias("sec"), nsec.alias("nsec")).withColumn("ns", N.to_ns(F.col("sec"), F.col("nsec")))


R.sql["p3_parsed_stamps"] = """SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_custkey ELSE 0 END AS sec, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey ELSE 0 END AS nsec
FROM orders"""


@R.query
def p3_parsed_stamps(spark, d):
    text = F.when(F.col("o_orderkey") % 10 == 0, F.lit("bad")).when(F.col("o_orderkey") % 5 == 0, F.lit("1_x")).otherwise(F.concat_ws("_", "o_custkey", "o_orderkey"))
    sec, nsec = N.parsed_stamp(text)
    return table(spark, d, "orders").select("o_orderkey", sec.alias("sec"), nsec.alias("nsec"))


R.sql["p4_legacy_fields"] = """SELECT vec_id, CASE WHEN vec_id % 4 = 0 THEN 0.0 ELSE round(embedding[2]::DOUBLE, 6) END AS linear_y, CASE
WHEN vec_id % 4 = 0 THEN 0.0 ELSE round(embedding[6]::DOUBLE, 6) END AS angular_z, label AS cp FROM embeddings"""


@R.query
def p4_legacy_fields(spark, d):
    six = F.when(F.col("vec_id") % 4 > 0, F.transform(F.slice("embedding", 1, 6), lambda x: x.cast("double")))
    linear, angular = N.legacy_velocity(six)
    out = table(spark, d, "embeddings").select("vec_id", linear[1].alias("linear_y"), angular[2].alias("angular_z"), F.col("label").alias("local_cp"), F.lit(0).alias("header"))
    return rounded(N.renamed(out, {"local_cp": "cp"}, ["header"]))


R.sql["p5_format"] = "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'unknown' END AS kind FROM events"


@R.query
def p5_format(spark, d):
    base = F.create_map(F.lit("sec"), F.lit("1"), F.lit("nsec"), F.lit("2"))
    more = F.map_concat(base, F.create_map(F.lit("header_img_left"), F.lit("3")))
    header = F.when(F.col("event_id") % 3 == 0, base).when(F.col("event_id") % 3 == 1, more).otherwise(F.from_json("props", "map<string,string>"))
    return table(spark, d, "events").select("event_id", N.legacy_format(header, ["header_img_left", "header_lcp"], ["sec", "nsec"]).alias("kind"))


R.sql["p6_backfill"] = """WITH k AS (SELECT user_id, min(epoch_us(ts)) FILTER (event_type = 'click') AS base, min(epoch_us(ts)) FILTER (event_type = 'view'
AND value > 50) AS view_us, min(epoch_us(ts)) FILTER (event_type = 'error' AND value > 60) AS error_us FROM events GROUP BY user_id)
SELECT user_id, coalesce(view_us, base) AS view_us, coalesce(error_us, base) AS error_us FROM k"""


@R.query
def p6_backfill(spark, d):
    first = lambda kind, least: F.min(F.when((F.col("event_type") == kind) & (F.col("value") > least), micros("ts")))
    df = table(spark, d, "events").groupBy("user_id").agg(first("click", -1e9).alias("base"), first("view", 50).alias("v"), first("error", 60).alias("e"))
    return df.select("user_id", *N.backfilled_stamps({"view_us": F.col("v"), "error_us": F.col("e")}, F.col("base")))


R.sql["p7_location"] = "SELECT event_id, coalesce(CASE WHEN event_id % 2 = 0 THEN json_extract_string(props, '$.k') END, 'arm ' || event_type) AS jaw FROM events"


@R.query
def p7_location(spark, d):
    top = F.when(F.col("event_id") % 2 == 0, F.get_json_object("props", "$.k"))
    return table(spark, d, "events").select("event_id", N.first_present(top, F.concat(F.lit("arm "), "event_type")).alias("jaw"))


R.sql["p8_clean_labels"] = "SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE event_type END AS label FROM events"


@R.query
def p8_clean_labels(spark, d):
    raw = F.when(F.col("event_type") == "error", F.lit(" NaN ")).when(F.col("event_type") == "signup", F.lit("None")).otherwise(F.concat(F.lit(" "), "event_type", F.lit("  ")))
    return table(spark, d, "events").select("event_id", N.clean_label(raw).alias("label"))


R.sql["p9_projected"] = "SELECT p_partkey, p_size::BIGINT AS p_size, NULL::DOUBLE AS p_weight, p_name FROM part"


@R.query
def p9_projected(spark, d):
    kinds = [("p_partkey", T.LongType()), ("p_size", T.LongType()), ("p_weight", T.DoubleType()), ("p_name", T.StringType())]
    return N.projected(table(spark, d, "part"), T.StructType([T.StructField(*k) for k in kinds]))


R.sql["p10_flattened"] = """SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS x, round(embedding[2]::DOUBLE, 6) AS y, CASE WHEN vec_id % 2 = 0 THEN round(embedding[6]::DOUBLE,
6) END AS twist_z, CASE WHEN vec_id % 3 = 0 THEN 0.0 ELSE round(embedding[7]::DOUBLE, 6) END AS gripper FROM embeddings"""


@R.query
def p10_flattened(spark, d):
    v = F.transform("embedding", lambda x: x.cast("double"))
    twist = F.slice(v, 1, F.when(F.col("vec_id") % 2 == 0, 6).otherwise(5))
    grip = F.slice(v, 7, F.when(F.col("vec_id") % 3 == 0, 0).otherwise(1))
    six = N.flattened(twist, ["a", "b", "c", "d", "e", "twist_z"], least=6)
    return rounded(table(spark, d, "embeddings").select("vec_id", *N.flattened(v, ["x", "y"]), six[5], *N.flattened(grip, ["gripper"], default=0.0)))


R.sql["p11_renamed_key"] = "SELECT event_id, json_extract_string(props, '$.k') AS key_value FROM events WHERE event_id % 6 > 0"


@R.query
def p11_renamed_key(spark, d):
    entries = F.from_json("props", "map<string,string>")
    df = table(spark, d, "events").withColumn("m", F.when(F.col("event_id") % 6 > 0, entries).otherwise(F.create_map(F.lit("x"), F.lit("1"))))
    return df.filter(F.map_contains_key("m", F.lit("k"))).select("event_id", N.renamed_key(F.col("m"), "k", "key")["key"].alias("key_value"))


R.sql["p12_episode_filter"] = """SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
AND o_totalprice > 100000"""


@R.query
def p12_episode_filter(spark, d):
    ids = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return S.episode_filter(table(spark, d, "orders"), {"o_orderstatus": "F"}, ids, "o_custkey", F.col("o_totalprice") > 100000).select("o_orderkey")


R.sql["p16_path_filter"] = "SELECT page_id FROM pages WHERE (url LIKE 'https://%' OR url LIKE '%/en/%') AND NOT url LIKE '%.net/%' AND NOT regexp_matches(url, '#top$')"


@R.query
def p16_path_filter(spark, d):
    return table(spark, d, "pages").filter(N.path_filter(F.col("url"), ["https://*", "*/en/*"], ["*.net/*", "*#top"])).select("page_id")


R.sql["p17_iso_times"] = """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE epoch_us(o_orderdate) * 1000 + CASE
WHEN o_orderkey % 4 = 1 THEN 250000000 ELSE 0 END END AS ns FROM orders"""


@R.query
def p17_iso_times(spark, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    n = F.col("o_orderkey") % 4
    text = F.when(n == 0, F.lit("soon")).when(n == 1, F.concat(day, F.lit("T00:00:00.25"))).when(n == 2, F.concat(day, F.lit("T02:00:00+02:00"))).otherwise(day)
    return table(spark, d, "orders").select("o_orderkey", N.iso_to_ns(text).alias("ns"))


R.sql["p18_log_lines"] = """SELECT l_returnflag AS stream, l_linenumber AS count, l_quantity AS elapsed_s, CASE WHEN l_partkey % 2 = 0 THEN l_discount END AS rate FROM lineitem
WHERE l_partkey % 3 > 0"""


@R.query
def p18_log_lines(spark, d):
    rate = F.when(F.col("l_partkey") % 2 == 0, F.concat(F.lit(" ("), "l_discount", F.lit(" fps)"))).otherwise("")
    line = F.concat(F.lit("10:00 | "), "l_returnflag", F.lit(":  "), "l_linenumber", F.lit(" PNGs in "), "l_quantity", F.lit("s"), rate)
    return N.log_lines(table(spark, d, "lineitem").select(F.when(F.col("l_partkey") % 3 > 0, line).otherwise("| no stream").alias("value")))


E = lambda k: F.col("embedding")[k].cast("double")
X = lambda k: f"embedding[{k + 1}]::DOUBLE"
TURN = (0.0, -1.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0)


def vectors(spark, d):
    return table(spark, d, "embeddings")


def unit(k=0):
    return Q.vector(E(k), E(k + 1), E(k + 2), E(k + 3))


SQ = "s AS (SELECT vec_id, embedding, {x} AS x, {y} AS y, {z} AS z, {w} AS w FROM embeddings), n AS (SELECT *, 2 / (x * x + y * y + z * z + w * w) AS s FROM s)".format(x=X(0), y=X(1), z=X(2), w=X(3))
ROT = ("1 - s * (y * y + z * z)", "s * (x * y - z * w)", "s * (x * z + y * w)", "s * (x * y + z * w)", "1 - s * (x * x + z * z)", "s * (y * z - x * w)", "s * (x * z - y * w)", "s * (y * z + x * w)", "1 - s * (x * x + y * y)")
R.sql["f1_quaternions"] = f"WITH {SQ} SELECT vec_id, round({ROT[1]}, 6) AS r01, round({ROT[8]}, 6) AS r22, " + ", ".join(f"round({c} / sqrt(x * x + y * y + z * z + w * w) * CASE WHEN w < 0 THEN -1 ELSE 1 END, 6) AS q{c}" for c in "xyzw") + " FROM n"


@R.query
def f1_quaternions(spark, d):
    df = vectors(spark, d).withColumn("r", Q.rotation(unit())).withColumn("q", Q.quaternion(F.col("r")))
    return rounded(df.select("vec_id", F.col("r")[1].alias("r01"), F.col("r")[8].alias("r22"), *(F.col("q")[k].alias(f"q{c}") for k, c in enumerate("xyzw"))))


R.sql["f2_measured_pose"] = f"""WITH {SQ} SELECT vec_id, round(-({X(5)} + 2) + 5, 6) AS tx, round({X(4)} + 1 + 6, 6) AS ty, round({X(6)} + 3 + 7, 6) AS tz, round(-({ROT[3]}),
6) AS r00 FROM n"""


@R.query
def f2_measured_pose(spark, d):
    eye = (1, 0, 0, 0, 1, 0, 0, 0, 1)
    df = vectors(spark, d).select("vec_id", Q.rotation(unit()).alias("r"), Q.vector(E(4), E(5), E(6)).alias("t"))
    r, t = Q.measured_pose(F.col("r"), F.col("t"), *Q.chained(eye, (1, 2, 3), TURN, (5, 6, 7)))
    df = df.select("vec_id", r.alias("r"), t.alias("t"))
    return rounded(df.select("vec_id", *(F.col("t")[k].alias(f"t{c}") for k, c in enumerate("xyz")), F.col("r")[0].alias("r00")))


R.sql["f3_setpoint_pose"] = f"""WITH {SQ} SELECT vec_id, CASE WHEN vec_id % 3 > 0 THEN round(-{X(5)} + 5, 6) END AS tx, CASE WHEN vec_id % 3 > 0 THEN round({ROT[0]}, 6) END AS r10
FROM n"""


@R.query
def f3_setpoint_pose(spark, d):
    there = F.col("vec_id") % 3 > 0
    df = vectors(spark, d).select("vec_id", F.when(there, Q.rotation(unit())).alias("r"), F.when(there, Q.vector(E(4), E(5), E(6))).alias("t"))
    r, t = Q.setpoint_pose(F.col("r"), F.col("t"), Q.matrix(TURN), Q.vector(5, 6, 7))
    return rounded(df.select("vec_id", t[0].alias("tx"), r[3].alias("r10")))


R.sql["f4_inverse_offset"] = f"""WITH {SQ} SELECT vec_id, round({X(4)}, 6) AS tx, round({X(5)}, 6) AS ty, round({ROT[2]}, 6) AS r02, round({X(4)} + CASE
WHEN vec_id % 2 = 0 THEN ({ROT[0]}) * 2 ELSE 0 END, 6) AS moved FROM n"""


@R.query
def f4_inverse_offset(spark, d):
    df = vectors(spark, d).select("vec_id", Q.rotation(unit()).alias("r"), Q.vector(E(4), E(5), E(6)).alias("t"))
    r, t = Q.inverse(F.col("r"), F.col("t"))
    df = df.withColumns({"ri": r, "ti": t})
    rr, tt = Q.inverse(F.col("ri"), F.col("ti"))  # back again
    offset = F.when(F.col("vec_id") % 2 == 0, Q.vector(1, 0, 0, 2, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1))
    return rounded(df.select("vec_id", tt[0].alias("tx"), tt[1].alias("ty"), rr[2].alias("r02"), Q.offset_pose(F.col("r"), F.col("t"), offset)[1][0].alias("moved")))


R.sql["f5_predicted"] = f"SELECT vec_id, round({X(0)} + ({X(6)} + {X(4)} * {X(2)} - {X(5)} * {X(1)}) / 30, 6) AS px FROM embeddings"


@R.query
def f5_predicted(spark, d):
    p = Q.predicted(Q.vector(E(0), E(1), E(2)), Q.vector(E(3), E(4), E(5)), Q.vector(E(6), E(7), E(8)), F.lit(30.0))
    return rounded(vectors(spark, d).select("vec_id", p[0].alias("px")))


R.sql["f6_projected"] = f"""SELECT vec_id, CASE WHEN {X(2)} > 0 THEN round(800 * ({X(0)} - 0.004) / greatest({X(2)}, 1e-9) + 320, 4) END AS u, CASE
WHEN {X(2)} > 0 THEN round(810 * {X(1)} / greatest({X(2)}, 1e-9) + 240, 4) END AS v FROM embeddings"""


@R.query
def f6_projected(spark, d):
    u, v = Q.projected(Q.vector(E(0), E(1), E(2)), 800, 810, 320, 240, 0.004)
    return rounded(vectors(spark, d).select("vec_id", u.alias("u"), v.alias("v")), 4)


R.sql["f7_outside"] = """SELECT l_returnflag, count(*) FILTER (NOT (l_quantity >= 0 AND l_quantity < 30 AND l_extendedprice >= 0 AND l_extendedprice < 50000)) AS n_outside
FROM lineitem GROUP BY l_returnflag"""


@R.query
def f7_outside(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count_if(Q.outside(F.col("l_quantity"), F.col("l_extendedprice"), 30, 50000)).alias("n_outside"))


R.sql["f8_depth"] = f"""SELECT vec_id, CASE WHEN {X(0)} <= 0.01 THEN NULL ELSE round((0.004183 * 1175.93 / {X(0)})::FLOAT::DOUBLE, 3) END AS depth_0,
len(list_filter(embedding, lambda x: x::DOUBLE <= 0.01))::INTEGER AS n_nan FROM embeddings"""


@R.query
def f8_depth(spark, d):
    df = vectors(spark, d).select("vec_id", Q.depth(F.transform("embedding", lambda x: x.cast("double")), 1175.93, 0.004183, 0.01).alias("z"))
    return df.select("vec_id", F.round(F.nanvl(F.col("z")[0], F.lit(None).cast("float")).cast("double"), 3).alias("depth_0"), F.size(F.filter("z", lambda x: F.isnan(x))).alias("n_nan"))


LEN = f"sqrt({X(0)} * {X(0)} + {X(1)} * {X(1)} + {X(2)} * {X(2)}) - 0.02"
R.sql["f9_depth_weight"] = f"""SELECT vec_id, round(exp((-({LEN}) + exp(-({LEN}))) / 2), 6) AS near_weight, round(1 / (1000 * greatest({LEN}, 4e-4)), 6) AS far_weight
FROM embeddings"""


@R.query
def f9_depth_weight(spark, d):
    p = Q.vector(E(0), E(1), E(2))
    return rounded(vectors(spark, d).select("vec_id", Q.depth_weight(p, True).alias("near_weight"), Q.depth_weight(p, False).alias("far_weight")))


R.sql["f10_polar"] = """WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity - 25.5 AS x, (l_discount - 0.055) * 100 AS y FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(sqrt(x * x + y * y), 6) AS length, round(CASE WHEN atan2(y, x) < 0 THEN atan2(y,
x) + 2 * pi() ELSE atan2(y, x) END, 6) AS angle FROM v"""


@R.query
def f10_polar(spark, d):
    length, angle = Q.polar(F.col("l_quantity") - 25.5, (F.col("l_discount") - 0.055) * 100)
    return rounded(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", length.alias("length"), angle.alias("angle")))


def stream_events(spark, d):
    return table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")).select("event_id", "ts", "user_id", "event_type", "value", "props")


NOBODY = -1


def write_slices(events, path, rows_each=2_000_000, least=4, order=("ts", "event_id"), closing=False):
    """Files of about rows_each rows in order of arrival, `least` at least; closing: and a last one with a row of user NOBODY far
    ahead, which lets the watermark pass all others."""
    n = max(least, -(-events.count() // rows_each))
    K.write_in_order(events, path, list(order), n)
    if closing:
        end = events.agg(F.max("event_id").alias("event_id"), (F.max("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts"))
        end.select("event_id", "ts", *(F.lit(NOBODY if f.name == "user_id" else None).cast(f.dataType).alias(f.name) for f in events.schema if f.name not in ("event_id", "ts"))).select(*events.columns).write.mode("append").parquet(path)


def replayed(spark, d, stream_of, output="append", files_per_batch=2, order=("ts", "event_id"), closing=False):
    """The events written as files in order of arrival, streamed through stream_of in several micro-batches, and the result
    read again."""
    events = stream_events(spark, d)
    source, sink, marks = (K.shared_path(spark, n) for n in ("replay", "live", "marks"))
    write_slices(events, source, order=order, closing=closing)
    L.run_once(stream_of(L.ingest(spark, source, events.schema, files_per_batch=files_per_batch)), sink, marks, output)
    K.removed(spark, source, marks)
    return spark.read.parquet(sink)


R.sql["r1_ingest"] = "SELECT event_id, user_id, event_type FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase')"


@R.query
def r1_ingest(spark, d):
    done = table(spark, d, "events").filter("event_type = 'purchase'").select("user_id").distinct()
    return replayed(spark, d, lambda s: s.join(done, "user_id", "left_semi")).select("event_id", "user_id", "event_type")


PERIOD = 3_600_000_000
R.sql["r2_live_contiguity"] = f"""WITH g AS (SELECT event_id, user_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events)
SELECT user_id, event_id, coalesce(gap < 1.5 * {PERIOD}, false) AS contiguous, CASE WHEN gap IS NULL THEN 0 ELSE greatest(0, least(127,
round_even(gap / {PERIOD}, 0)::BIGINT - 1)) END::INTEGER AS drops FROM g"""


@R.query
def r2_live_contiguity(spark, d):
    return live_contiguity(spark, d)


def live_contiguity(spark, d, **options):
    out = replayed(spark, d, lambda s: L.monitored(s.withColumn("us", F.unix_micros("ts")), "user_id", "us", "event_id", PERIOD), closing=True, **options)
    return out.filter(F.col("user_id") != NOBODY)


R.sql["r2_live_reordered"] = R.sql["r2_live_contiguity"]


@R.query
def r2_live_reordered(spark, d):
    """Frames arrive up to nine minutes late, so each micro-batch is out of order and mixed with its neighbours."""
    return live_contiguity(spark, d, order=(F.unix_seconds("ts") + F.pmod(F.xxhash64("event_id"), F.lit(540)), "event_id"))


R.sql["r3_sync_health"] = """WITH w AS (SELECT time_bucket(INTERVAL '1 hour', ts::TIMESTAMP) AS start, event_type, count(value) AS n, count(*) FILTER (abs(value) > 20) AS n_out,
round(max(abs(value)), 6) AS max_delta FROM events GROUP BY ALL)
SELECT epoch_us(start) AS start_us, event_type, n, n_out, max_delta FROM w WHERE start + INTERVAL '1 hour' <= (SELECT max(ts)::TIMESTAMP
FROM events) - INTERVAL '10 minutes'"""


@R.query
def r3_sync_health(spark, d):
    out = replayed(spark, d, lambda s: L.sync_health(s, "ts", "event_type", "value", 20, "1 hour"))
    return rounded(out.select(F.unix_micros("start").alias("start_us"), "event_type", "n", "n_out", "max_delta"))


R.sql["r4_live_nearest"] = """WITH m AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'click'), p AS (SELECT user_id, event_id, ts FROM events
WHERE event_type = 'purchase'),
x AS (SELECT m.user_id, m.event_id, p.event_id AS match, epoch_us(p.ts) - epoch_us(m.ts) AS delta, m.ts FROM m JOIN p ON m.user_id = p.user_id
AND abs(epoch_us(p.ts) - epoch_us(m.ts)) <= 1800000000),
o AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_id ORDER BY abs(delta), -delta, match) AS o FROM x) SELECT user_id, event_id, match,
delta FROM o WHERE o = 1"""


@R.query
def r4_live_nearest(spark, d):
    return nearest_live(spark, d, "inner")


def nearest_live(spark, d, how):
    def both(s):
        # one stream on both sides; the closing row is on both
        kind = lambda k: s.filter((F.col("event_type") == k) | (F.col("user_id") == NOBODY))
        return L.nearest_live(kind("click"), kind("purchase"), "user_id", "ts", "event_id", "30 minutes", how=how)

    return replayed(spark, d, both, closing=True)


R.sql["r4_live_every_master"] = R.sql["r4_live_nearest"].replace("SELECT user_id, event_id, match,\ndelta FROM o WHERE o = 1", """SELECT m.user_id, m.event_id, o.match,
o.delta FROM m LEFT JOIN o ON o.user_id = m.user_id AND o.event_id = m.event_id AND o.o = 1""")


@R.query
def r4_live_every_master(spark, d):
    """Masters without a sample near enough come out too, as in the batch form."""
    return nearest_live(spark, d, "leftOuter")
