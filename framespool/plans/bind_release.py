"""Release rules, release tables and export layouts on tables that Spark derives from the driver's."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.catalog import TOPICS
from ..operators import integrity as I
from ..operators import profile as P
from ..operators import release_rules as U
from ..sources import release as L
from ..sources import scans as S
from ..sources import sinks as K
from .bind_integrity import files
from .tables import Registry, rounded, table

R = Registry()
FOLDERS = (*U.REQUIRED_FOLDERS, *U.OPTIONAL_FOLDERS)


def listed(names) -> str:
    return "[" + ", ".join(f"'{x}'" for x in names) + "]"


def chosen(names, at):
    """The name at a number, from 0, by its remainder."""
    return F.get(F.array(*(F.lit(x) for x in names)), F.pmod(at, F.lit(len(names))).cast("int"))


# --- V1: customers are the clips that are expected, events their files --------------------------------------------
COUNTED = [f for f in U.REQUIRED_FOLDERS if f not in U.WITHOUT_FRAMES]
R.sql["v1_raw_clip_rules"] = f"""WITH f AS (SELECT user_id AS clip, ({listed(FOLDERS)})[1 + event_id % {len(FOLDERS)}] AS folder, count(*) AS frames FROM events GROUP BY ALL),
c AS (SELECT c_custkey AS clip, c_custkey % 7 > 0 AS has_meta, c_custkey IN (SELECT clip FROM f) AS there FROM customer), m AS (SELECT clip,
max(frames) AS most FROM f WHERE list_contains({listed(COUNTED)}, folder) GROUP BY clip),
w AS (SELECT clip, unnest({listed(FOLDERS)}) AS folder FROM c WHERE there), g AS (SELECT clip, folder, list_contains({listed(U.OPTIONAL_FOLDERS)},
folder) AS free FROM w ANTI JOIN f USING (clip, folder))
SELECT 'ERROR' AS severity, 'raw_clip_missing' AS code, clip::VARCHAR AS key, 'the clip has no folders' AS message FROM c WHERE NOT there
UNION ALL SELECT 'ERROR', 'raw_missing_meta', clip::VARCHAR, 'no metadata' FROM c WHERE there AND NOT has_meta
UNION ALL SELECT CASE WHEN free THEN 'INFO' ELSE 'ERROR' END, CASE WHEN free THEN 'raw_missing_optional' ELSE 'raw_missing_subdir' END, clip::VARCHAR,
'no folder ' || folder FROM g
UNION ALL SELECT 'ERROR', 'raw_frame_count_mismatch', clip::VARCHAR, folder || ' has ' || frames || ' frames of ' || most FROM f JOIN m USING (clip)
JOIN c USING (clip) WHERE list_contains({listed(COUNTED)}, folder) AND frames <> most"""


@R.query
def v1_raw_clip_rules(spark, d):
    clips = table(spark, d, "customer").select(F.col("c_custkey").alias("clip"), (F.col("c_custkey") % 7 > 0).alias("has_meta"))
    folders = table(spark, d, "events").groupBy(F.col("user_id").alias("clip"), chosen(FOLDERS, F.col("event_id")).alias("folder")).agg(F.count("*").alias("frames"))
    return U.raw_clip_rules(clips, folders)


# --- V2: orders are episodes, their lines the rows of the frame tables --------------------------------------------
ROWS = f"SELECT l_orderkey AS episode, ({listed(U.MODALITIES)})[1 + (l_linenumber + l_partkey) % 5] AS modality, count(*) AS n FROM lineitem GROUP BY ALL"
R.sql["v2_packed_episode_rules"] = f"""WITH n AS ({ROWS}),
o AS (SELECT o_orderkey AS episode, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderkey % 10 = 8 THEN 'running'
WHEN o_orderkey % 10 = 9 THEN 'failed' ELSE 'complete' END AS state, o_orderkey % 11 > 0 AS has_meta, o_orderkey % 13 > 0 AS readable,
CASE WHEN o_orderkey % 17 > 0 THEN '1' WHEN o_orderkey % 2 = 0 THEN '0' END AS version, o_orderkey % 100 / 100.0 AS contiguity,
o_orderkey % 19 > 0 AS has_raw FROM orders),
c AS (SELECT * FROM o WHERE state = 'complete'), k AS (SELECT * FROM c WHERE has_meta AND readable), w AS (SELECT episode,
unnest({listed(U.MODALITIES)}) AS modality FROM k)
SELECT 'ERROR' AS severity, 'ep_incomplete' AS code, episode::VARCHAR AS key, 'not complete: ' || CASE state WHEN 'running' THEN 'in flight'
WHEN 'failed' THEN 'failed before' ELSE 'never finished' END AS message FROM o WHERE state IS DISTINCT FROM 'complete'
UNION ALL SELECT 'ERROR', 'ep_missing_meta', episode::VARCHAR, 'no metadata' FROM c WHERE NOT has_meta UNION ALL SELECT 'ERROR', 'ep_schema_drift',
episode::VARCHAR, 'the metadata don''t fit their schema' FROM c WHERE has_meta AND NOT readable
UNION ALL SELECT 'ERROR', 'ep_schema_version_mismatch', episode::VARCHAR, 'schema version ' || coalesce(version, 'none') FROM k
WHERE version IS DISTINCT FROM '1'
UNION ALL SELECT 'ERROR', 'ep_missing_parquet', episode::VARCHAR, 'no table ' || modality FROM w ANTI JOIN n USING (episode, modality)
UNION ALL SELECT 'ERROR', 'ep_length_mismatch', episode::VARCHAR, modality || ' has ' || n || ' rows of 1' FROM w JOIN n USING (episode, modality)
WHERE n <> 1
UNION ALL SELECT 'ERROR', 'ep_low_contiguity', episode::VARCHAR, 'contiguity under 0.2' FROM k WHERE contiguity < 0.2 UNION ALL SELECT 'WARNING',
'ep_no_video_raw', episode::VARCHAR, 'raw images can''t be rebuilt' FROM k WHERE NOT has_raw"""


def table_rows(spark, d):
    modality = chosen(U.MODALITIES, F.col("l_linenumber") + F.col("l_partkey"))
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("episode"), modality.alias("modality")).agg(F.count("*").alias("n"))


@R.query
def v2_packed_episode_rules(spark, d):
    k = F.col("o_orderkey")
    state = F.when(F.col("o_orderstatus") != "P", F.when(k % 10 == 8, "running").when(k % 10 == 9, "failed").otherwise("complete"))
    episodes = table(spark, d, "orders").select(
        k.alias("episode"), state.alias("state"), (k % 11 > 0).alias("has_meta"), (k % 13 > 0).alias("readable"), F.when(k % 17 > 0, "1").when(k % 2 == 0, "0").alias("schema_version"),
        F.lit(1).cast("long").alias("length"), (k % 100 / 100).alias("contiguity"), (k % 19 > 0).alias("has_raw_video"),
    )
    return U.episode_rules(episodes, table_rows(spark, d), "1", 0.2)


# --- V3: orders are what is stored, their lines the index; documents are the files --------------------------------
SHARE = 0.2
R.sql["v3_release_rules"] = f"""WITH disk AS (SELECT o_orderkey AS e FROM orders), idx AS (SELECT DISTINCT l_orderkey AS e FROM lineitem), lines AS (SELECT e FROM idx
WHERE e % 50 > 0 UNION SELECT c_custkey + 100000000 FROM customer WHERE c_custkey % 100 = 0),
n AS ({ROWS}), s AS (SELECT e AS episode FROM disk), w AS (SELECT episode, unnest({listed(U.MODALITIES)}) AS modality FROM s),
a AS (SELECT 'doc/' || doc_id AS path, text, doc_id % 17 > 0 AS there, doc_id % 23 > 0 AS listed, CASE
WHEN doc_id % 5 = 0 THEN text || 'x' ELSE text END AS other FROM documents WHERE text IS NOT NULL),
b AS (SELECT *, ('0x' || substr(md5(path), 1, 8))::BIGINT AS bucket FROM a WHERE there AND listed)
SELECT 'ERROR' AS severity, 'I-1' AS code, e::VARCHAR AS key, 'only on the left' AS message FROM disk ANTI JOIN idx USING (e) UNION ALL
SELECT 'ERROR', 'I-2', e::VARCHAR, 'only on the right' FROM idx ANTI JOIN disk USING (e)
UNION ALL SELECT 'ERROR', 'I-3', e::VARCHAR, 'only on the left' FROM lines ANTI JOIN idx USING (e) UNION ALL SELECT 'ERROR', 'I-3', e::VARCHAR,
'only on the right' FROM idx ANTI JOIN lines USING (e)
UNION ALL SELECT 'ERROR', 'I-4', episode::VARCHAR, 'no table ' || modality FROM w ANTI JOIN n USING (episode, modality) UNION ALL SELECT 'ERROR',
'I-4', episode::VARCHAR, modality || ' has ' || n || ' rows of 1' FROM w JOIN n USING (episode, modality) WHERE n <> 1
UNION ALL SELECT 'ERROR', 'I-5', path, CASE WHEN there THEN 'only on the left' ELSE 'only on the right' END FROM a WHERE there <> listed
UNION ALL SELECT 'ERROR', 'I-5', path, 'hash differs' FROM b WHERE text <> other AND (bucket < ({SHARE} * 4294967296)::BIGINT OR (bucket,
path) = (SELECT (min((bucket, path))) FROM b))
UNION ALL SELECT 'ERROR', 'I-6', p_brand, 'unknown: ' || p_type FROM (SELECT DISTINCT p_brand, p_type FROM part WHERE p_brand IN ('Brand#1',
'Brand#2') AND p_type NOT IN ('SMALL', 'ECONOMY'))
UNION ALL SELECT DISTINCT 'ERROR', 'I-7', event_type, 'not declared' FROM events WHERE event_type NOT IN ('click', 'view')"""


@R.query
def v3_release_rules(spark, d):
    disk = table(spark, d, "orders").select(F.col("o_orderkey").alias("episode"))
    index = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("episode"))
    extra = table(spark, d, "customer").filter("c_custkey % 100 = 0").select((F.col("c_custkey") + 100_000_000).alias("episode"))
    declared = disk.withColumn("length", F.lit(1))
    docs = table(spark, d, "documents").filter("text IS NOT NULL").withColumn("path", F.concat(F.lit("doc/"), "doc_id"))
    other = F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    manifest = docs.filter("doc_id % 23 > 0").select("path", F.sha2(other, 256).alias("sha256"))
    labels = table(spark, d, "part").select(F.col("p_brand").alias("family"), F.col("p_type").alias("value"))
    words = spark.createDataFrame([(b, t) for b in ("Brand#1", "Brand#2") for t in ("SMALL", "ECONOMY")], "family string, value string")
    tasks = spark.createDataFrame([("click",), ("view",)], "task string")
    return U.joined(
        [
            U.index_rules(disk, index, index.filter("episode % 50 > 0").unionByName(extra)), U.length_rules(declared, table_rows(spark, d)),
            U.manifest_rules(docs.filter("doc_id % 17 > 0").select("path", F.col("text").alias("content")), manifest, SHARE), U.vocabulary_rules(labels, words),
            U.task_rules(table(spark, d, "events").select(F.col("event_type").alias("task")), tasks),
        ]
    )


# --- V4: suppliers are exports, lines their files and features ----------------------------------------------------
PATHS = ("videos/case-000/a/episode_000000.mp4", "videos/notes.txt", "data/case-000/episode_000000.parquet", "data/case-000/notes.txt", "data/notes.txt", *U.EXPORT_FILES, "other/file")
FEATURES = (*U.EXPORT_FEATURES, "observation.images.left", "observation.images.side", "observation.meta.tool", "other")
_NO = "UNION ALL SELECT '{s}', '{c}', e::VARCHAR, {m} FROM x WHERE {w} "
R.sql["v4_learning_export_rules"] = (
    f"""WITH p AS (SELECT DISTINCT l_suppkey AS e, ({listed(PATHS)})[1 + (l_partkey + l_linenumber) % {len(PATHS)}] AS path FROM lineitem
WHERE l_suppkey % 9 > 0 OR l_linenumber < 3),
f AS (SELECT l_suppkey AS e, ({listed(FEATURES)})[1 + l_partkey % {len(FEATURES)}] AS feature, min(l_quantity)::INTEGER * 100 AS height,
max(l_quantity)::INTEGER * 12 AS width FROM lineitem WHERE l_suppkey % 8 > 0 OR l_linenumber < 3 GROUP BY ALL),
s AS (SELECT s_suppkey AS e, s_suppkey % 40 AS fps, CASE WHEN s_suppkey % 5 > 0 THEN 'arm' END AS robot, CASE s_suppkey % 3 WHEN 1 THEN ['train',
'val', 'test', 'recovery'] WHEN 2 THEN ['train'] END AS splits,
CASE WHEN s_suppkey % 4 = 1 THEN ['cut'] WHEN s_suppkey % 4 = 2 THEN []::VARCHAR[] END AS tasks, CASE s_suppkey % 6 WHEN 1 THEN 'By TimeStamps'
WHEN 2 THEN 'none' END AS readme FROM supplier),
x AS (SELECT s.*, coalesce((SELECT list(path) FROM p WHERE p.e = s.e), []) AS paths, coalesce((SELECT list(feature) FROM f WHERE f.e = s.e),
[]) AS features FROM s)
SELECT 'WARNING' AS severity, 'image' AS code, e::VARCHAR AS key, feature || ' is ' || height || 'x' || width AS message FROM f
WHERE starts_with(feature, 'observation.images.') AND (height < 480 OR width < 480) AND e IN (SELECT e FROM s) """
    + "".join(_NO.format(s="ERROR", c="structure", m=f"'no folder {n}'", w=f"len(list_filter(paths, lambda y: starts_with(y, '{n}/'))) = 0") for n in U.EXPORT_FOLDERS)
    + _NO.format(s="ERROR", c="structure", m="'no case folder under data'", w="len(list_filter(paths, lambda y: starts_with(y, 'data/'))) > 0 AND len(list_filter(paths, lambda y: starts_with(y, 'data/case-'))) = 0")
    + _NO.format(s="ERROR", c="structure", m="'no episode in the case folders'", w="len(list_filter(paths, lambda y: starts_with(y, 'data/case-'))) > 0 AND len(list_filter(paths, lambda y: y LIKE 'data/case-%/episode_%.parquet')) = 0")
    + "".join(_NO.format(s="ERROR", c="metadata", m=f"'no {n}'", w=f"NOT list_contains(paths, '{n}')") for n in U.EXPORT_FILES)
    + _NO.format(s="WARNING", c="info", m="fps || ' frames a second, under 20'", w="fps < 20") + _NO.format(s="WARNING", c="info", m="'no robot type'", w="robot IS NULL")
    + _NO.format(s="WARNING", c="info", m="'no splits'", w="splits IS NULL")
    + "".join(_NO.format(s="WARNING", c="splits", m=f"'no split {n}'", w=f"splits IS NOT NULL AND NOT list_contains(splits, '{n}')") for n in U.EXPORT_SPLITS)
    + _NO.format(s="INFO", c="splits", m="'no recovery examples'", w="splits IS NOT NULL AND NOT list_contains(splits, 'recovery')")
    + "".join(_NO.format(s="ERROR", c="features", m=f"'no feature {n}'", w=f"NOT list_contains(features, '{n}')") for n in U.EXPORT_FEATURES)
    + _NO.format(s="WARNING", c="features", m="'no image feature'", w="len(list_filter(features, lambda y: starts_with(y, 'observation.images.'))) = 0")
    + _NO.format(s="INFO", c="features", m="'no tool, force, probe or instruction feature'", w="NOT list_contains(features, 'observation.meta.tool')")
    + _NO.format(s="WARNING", c="video", m="'no video'", w="len(list_filter(paths, lambda y: starts_with(y, 'videos/'))) > 0 AND len(list_filter(paths, lambda y: y LIKE '%.mp4')) = 0")
    + _NO.format(s="WARNING", c="tasks", m="'no task'", w="coalesce(len(tasks), 0) = 0") + _NO.format(s="WARNING", c="synchronisation", m="'not documented'", w="readme = 'none'")
)


@R.query
def v4_learning_export_rules(spark, d):
    k, lines = F.col("s_suppkey"), table(spark, d, "lineitem").withColumnRenamed("l_suppkey", "export")
    words = lambda *x: F.array(*(F.lit(w) for w in x)).cast("array<string>")
    exports = table(spark, d, "supplier").select(
        k.alias("export"), (k % 40).alias("fps"), F.when(k % 5 > 0, "arm").alias("robot"), F.when(k % 3 == 1, words("train", "val", "test", "recovery")).when(k % 3 == 2, words("train")).alias("splits"),
        F.when(k % 4 == 1, words("cut")).when(k % 4 == 2, words()).alias("tasks"), F.when(k % 6 == 1, "By TimeStamps").when(k % 6 == 2, "none").alias("readme"),
    )
    paths = lines.filter("export % 9 > 0 OR l_linenumber < 3").select("export", chosen(PATHS, F.col("l_partkey") + F.col("l_linenumber")).alias("path")).distinct()
    features = lines.filter("export % 8 > 0 OR l_linenumber < 3").groupBy("export", chosen(FEATURES, F.col("l_partkey")).alias("feature")).agg(
        (F.min("l_quantity").cast("int") * 100).alias("height"), (F.max("l_quantity").cast("int") * 12).alias("width")
    )
    return U.export_rules(exports, paths, features.join(exports.select("export"), "export", "left_semi"))


# --- S9, S10: events as the frames of a release --------------------------------------------------------------------
def frame_tables(spark, d):
    """Users as episodes of ten datasets and two tasks, their events as frames in order of time."""
    from pyspark.sql import Window

    us = F.unix_micros(F.col("ts").cast("timestamp"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    events = table(spark, d, "events").select(
        F.concat(F.lit("set"), F.col("user_id") % 10).alias("dataset"), F.when(F.col("user_id") % 3 == 0, "cut").otherwise("sew").alias("task"), F.concat(F.lit("clip"), "user_id").alias("episode_id"),
        (F.row_number().over(w) - 1).alias("frame_index"), (us * 1000).alias("master_timestamp_ns"), F.col("event_id").cast("int").alias("source_frame_index"), "event_type", "value", "user_id",
    )
    vector = lambda k: F.array((F.col("value") * k).cast("float"))
    return {
        "timestamp": events, "ECM": events.withColumn("measured_cp.position", vector(1)), "PSM1": events.withColumn("measured_cp.position", vector(2)),
        "PSM2": events.withColumn("jaw.measured_position", F.col("value").cast("float")), "annotation": events.withColumn("phase", F.col("event_type")),
    }


def written(spark, d):
    path, tables = K.shared_path(spark, "release"), frame_tables(spark, d)
    L.write_release(tables, path, tables["timestamp"].filter("user_id % 4 > 0"))
    return L.open_release(spark, path)


FRAMES = """f AS (SELECT 'set' || user_id % 10 AS dataset, CASE WHEN user_id % 3 = 0 THEN 'cut' ELSE 'sew' END AS task, 'clip' || user_id AS episode_id,
(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)::INTEGER AS frame_index, epoch_us(ts) * 1000 AS ns, event_id, event_type,
value::FLOAT AS value, user_id FROM events)"""
R.sql["s9_release_frames"] = f"""WITH {FRAMES} SELECT dataset, episode_id, frame_index, round((value * 2)::FLOAT::DOUBLE, 4) AS x FROM f WHERE user_id % 4 > 0 AND task = 'cut'
AND dataset <> 'set3'"""


@R.query
def s9_release_frames(spark, d):
    """Completed episodes of one task, one column of one arm."""
    x = written(spark, d).filter(task="cut", predicate=F.col("dataset") != "set3").column("PSM1", "measured_cp.position")
    return x.select("dataset", "episode_id", "frame_index", F.round(F.col("`measured_cp.position`")[0].cast("double"), 4).alias("x"))


R.sql["s10_release_tables"] = f"""WITH {FRAMES}, m AS (SELECT unnest({listed(U.MODALITIES)}) AS modality)
SELECT modality, dataset, task, count(*) AS n, sum(frame_index)::BIGINT AS frames, sum(ns % 1000000007)::BIGINT AS stamps, count(CASE
WHEN modality = 'annotation' THEN event_type WHEN modality = 'PSM2' THEN 'x' END) AS labelled,
CASE modality WHEN 'timestamp' THEN {5 + len(TOPICS)} WHEN 'ECM' THEN 15 WHEN 'annotation' THEN 8 ELSE 24 END AS n_columns FROM f, m
WHERE user_id % 4 > 0 GROUP BY ALL"""


@R.query
def s10_release_tables(spark, d):
    """All five tables of the completed episodes, with their declared columns."""
    release, parts = written(spark, d), []
    for name, schema in L.SCHEMAS.items():
        label = {"annotation": "phase", "PSM2": "`jaw.measured_position`"}.get(name)
        parts.append(
            release.frames(name).groupBy("dataset", "task").agg(
                F.count("*").alias("n"), F.sum(F.col("frame_index").cast("long")).alias("frames"), F.sum(F.col("master_timestamp_ns") % 1_000_000_007).alias("stamps"),
                F.count(label if label else F.lit(None)).alias("labelled"), F.lit(len(schema.fields)).alias("n_columns"),
            ).withColumn("modality", F.lit(name))
        )
    return U.joined(parts)


# --- S1, S12, S14 --------------------------------------------------------------------------------------------------
STAMPED = list(TOPICS)
R.sql["s1_all_topics"] = (
    "SELECT event_id::INTEGER AS frame, epoch_us(ts) * 1000 AS image_left, "
    + ", ".join(f'CASE WHEN event_id % 25 <> {k} THEN (epoch_us(ts) + {k}) * 1000 END AS "{name.replace(".", "__")}"' for k, name in enumerate(STAMPED)) + " FROM events"
)


@R.query
def s1_all_topics(spark, d):
    """Every topic of the catalogue, each missing on some frames."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    stamp = lambda x: F.struct(F.floor(x / 1_000_000).alias("sec"), (F.pmod(x, F.lit(1_000_000)) * 1000).alias("nsec"))
    tree: dict = {}
    for k, keys in enumerate(TOPICS.values()):
        *above, last = keys.split("/")
        at = tree
        for step in above:
            at = at.setdefault(step, {})
        at[last] = F.when(F.col("event_id") % 25 != k, stamp(us + k))
    built = lambda x: F.struct(*((built(v) if isinstance(v, dict) else v).alias(n) for n, v in x.items()))
    doc = built(tree | {"image_left_stamp": stamp(us)})
    path = F.concat(F.lit("/data/online_set/"), "user_id", F.lit("/time_syn/"), "event_id", F.lit(".json"))
    docs = K.documents_of(table(spark, d, "events"), path, doc).select(F.col("rel_path").alias("path"), F.col("payload").alias("value"))
    return S.stamp_documents(docs).drop("dataset", "clip")


R.sql["s12_vocabulary_lines"] = """WITH w AS (SELECT DISTINCT p_brand AS task, p_type AS family, p_size::VARCHAR AS id, 'size ' || p_size AS text FROM part),
l AS (SELECT task, string_agg('{"family":"' || family || '","id":"' || id || '","text":"' || text || '"}', ',' ORDER BY family, id) AS words FROM w
GROUP BY task)
SELECT task, '{"task":"' || task || '","instruction":"do ' || task || '","words":[' || words || ']}' AS line FROM l UNION ALL
SELECT DISTINCT c_mktsegment, '{"task":"' || c_mktsegment || '","instruction":"do ' || c_mktsegment || '","words":[]}' FROM customer"""


@R.query
def s12_vocabulary_lines(spark, d):
    words = table(spark, d, "part").select(F.col("p_brand").alias("task"), F.col("p_type").alias("family"), F.col("p_size").cast("string").alias("id"), F.concat(F.lit("size "), "p_size").alias("text")).distinct()
    tasks = words.select("task").unionByName(table(spark, d, "customer").select(F.col("c_mktsegment").alias("task"))).distinct()
    return L.vocabulary_lines(tasks.withColumn("instruction", F.concat(F.lit("do "), "task")), words).withColumnRenamed("value", "line")


R.sql["s14_export_files"] = """WITH f AS (SELECT user_id // 100 AS case_id, user_id AS episode_id, user_id % 3 AS task_index, epoch_us(ts) AS us FROM events),
e AS (SELECT case_id, episode_id, count(*) AS length, max(us) - min(us) AS span, 'data/case-' || lpad(case_id::VARCHAR, 3,
'0') || '/episode_' || lpad(episode_id::VARCHAR, 6, '0') || '.parquet' AS file, 'task ' || any_value(task_index) AS tasks FROM f GROUP BY case_id,
episode_id)
SELECT file, length, span, tasks FROM e UNION ALL SELECT 'meta/info', sum(length)::BIGINT, count(*),
count(DISTINCT case_id) || ' chunks ' || (SELECT count(DISTINCT task_index) FROM f) || ' tasks' FROM e"""


@R.query
def s14_export_files(spark, d):
    """File names, lengths and tasks of a learning export, and its totals."""
    user = F.col("user_id")
    frames = table(spark, d, "events").select(
        F.floor(user / 100).cast("int").alias("case_id"), user.alias("episode_id"), (user % 3).alias("task_index"), F.concat(F.lit("task "), user % 3).alias("task"),
        F.col("event_id").alias("frame_index"), F.unix_micros(F.col("ts").cast("timestamp")).alias("timestamp"),
    )
    episodes, _, info = L.export_metadata(frames, 30)
    one = info.select(F.lit("meta/info").alias("file"), F.col("total_frames").alias("length"), F.col("total_episodes").alias("span"), F.concat("total_chunks", F.lit(" chunks "), "total_tasks", F.lit(" tasks")).alias("tasks"))
    return episodes.select("file", "length", (F.col("end") - F.col("start")).alias("span"), F.array_join("tasks", ",").alias("tasks")).unionByName(one)


# --- A17, A18, V5, V6 ----------------------------------------------------------------------------------------------
R.sql["a17_size_buckets"] = """WITH f AS (SELECT source, coalesce(strlen(text), 0) AS size FROM documents), b AS (SELECT source, count(*) AS n_files, sum(size)::BIGINT AS bytes,
round(sum(size) / sum(sum(size)) OVER (), 6) AS share FROM f GROUP BY source)
SELECT source, n_files, bytes, share FROM b UNION ALL SELECT 'unpacked / packed', NULL, sum(size)::BIGINT, round(sum(size) / sum(CASE
WHEN source <> 'src3' THEN size END), 6) FROM f"""


@R.query
def a17_size_buckets(spark, d):
    docs = table(spark, d, "documents").withColumn("size", F.coalesce(F.octet_length("text").cast("long"), F.lit(0)))
    ratio = P.size_ratio(docs.filter("source <> 'src3'"), docs, "size")
    one = ratio.select(F.lit("unpacked / packed").alias("source"), F.lit(None).cast("long").alias("n_files"), F.col("unpacked").alias("bytes"), F.col("ratio").alias("share"))
    return rounded(P.size_buckets(docs, "source", "size").unionByName(one))


R.sql["a18_contacts_per_arm"] = """SELECT 'PSM1' AS arm, count(*) FILTER (toxic <> 0) AS n_contacts, count(toxic) AS n_labels FROM labels UNION ALL SELECT 'PSM2',
count(*) FILTER (quality <> 0), count(quality) FROM labels"""


@R.query
def a18_contacts_per_arm(spark, d):
    return P.contacts_per_arm(table(spark, d, "labels"), {"PSM1": "toxic", "PSM2": "quality"})


SHIPPED = "path NOT LIKE '.logs/%' AND path NOT LIKE '%/.clip.complete.json' AND path <> 'meta/manifest.json'"
PATH = """CASE WHEN doc_id % 10 = 0 THEN '.logs/' || doc_id WHEN doc_id % 10 = 1 THEN 'a/' || doc_id || '/.clip.complete.json'
WHEN doc_id = 12 THEN 'meta/manifest.json' ELSE 'a/' || doc_id END"""
R.sql["v5_manifest_totals"] = f"""WITH f AS (SELECT {PATH} AS path, strlen(text) AS size FROM documents) SELECT count(*) AS total_files, coalesce(sum(size), 0)::BIGINT AS total_bytes
FROM f WHERE {SHIPPED}"""


@R.query
def v5_manifest_totals(spark, d):
    """What a release ships: internal folders, markers and the manifest itself don't count."""
    docs = table(spark, d, "documents").withColumn("path", F.expr(PATH))
    return I.manifest_totals(I.manifest(docs, "path", "text"))


R.sql["v6_verdict"] = """WITH a AS (SELECT text, doc_id % 17 > 0 AS there, CASE WHEN doc_id % 11 = 0 THEN text || 'x' ELSE text END AS other FROM documents
WHERE source <> 'src3'),
s AS (SELECT CASE WHEN NOT there THEN 'MISSING' WHEN strlen(text) <> strlen(other) THEN 'SIZE' ELSE 'OK' END AS status FROM a) SELECT status,
count(*) AS n, status <> 'OK' AS fails FROM s GROUP BY status"""


@R.query
def v6_verdict(spark, d):
    changed = F.when(F.col("doc_id") % 11 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    there = files(spark, d, changed).filter(F.substring("path", 5, 20).cast("long") % 17 > 0)
    return I.verdict(I.verified(files(spark, d), there))
