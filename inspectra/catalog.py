"""Registered queries and their SQL counterparts, side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from .functions import events as ev
from .functions import keys, verdict
from .operators import cluster, density, descriptors, fusion, metrics, neighbours, regions, registry, results, vectors
from .operators.regions_sql import masks_sql
from .plans import clustering
from .plans.retrain import retrain
from .sources import assets, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_R = fx.REGISTRY
_RES = fx.RESULTS
_LOW, _HIGH = verdict.SHIPPED_LOWER, verdict.SHIPPED_UPPER


def query(sql: str | None = None):
    """Register a query under its name; its SQL has the function's columns."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _events(s: SparkSession, d: str) -> DataFrame:
    return s.read.parquet(f"{d}/events.parquet")


def _embeddings(s: SparkSession, d: str) -> DataFrame:
    return s.read.parquet(f"{d}/embeddings.parquet")


def _patches(s: SparkSession, d: str) -> DataFrame:
    return fx.view(s, d, fx.PATCHES, "embeddings")


def _bank(s: SparkSession, d: str) -> DataFrame:
    return fx.view(s, d, fx.BANK, "embeddings")


def _ctes(**views: str) -> str:
    return "with " + ", ".join(f"{k} as ({fx.duck(v)})" for k, v in views.items())


# Relational queries.


@query(f"""with r as ({_R}) select model_type, model_id, bucket, major_version, minor_version, patch_version,
  concat_ws('.', major_version, minor_version, patch_version) as version from r where is_valid
  qualify row_number() over (partition by model_type order by major_version desc, minor_version desc, patch_version desc, model_id desc) = 1""")
def latest_model(s, d):
    return registry.latest_by_type(fx.registry(s))


@query(f"with r as ({_R}) select model_type, major_version, minor_version, max(patch_version) + 1 as next_patch from r group by all")
def next_patch(s, d):
    return registry.next_patches(fx.registry(s))


_GOOD = f"""good as (select res.* from res join r on res.model_id = r.model_id where status = 'normal' and model_type = 'patchcore'
  order by inferred_at desc, event_id limit 200)"""


@query(f"with r as ({_R}), res as ({_RES}), {_GOOD} select event_id, model_id, object_key, round(anomaly_score, 6) as anomaly_score from good")
def recent_good(s, d):
    return results.recent_good(fx.results(s, d), fx.registry(s), "patchcore", 200).select("event_id", "model_id", "object_key", F.round("anomaly_score", 6).alias("anomaly_score"))


_RECENT = """select event_id, image_id, model_id, object_key, anomaly_score, status, heatmap_key, strftime(inferred_at, '%Y-%m-%dT%H:%M:%S') as inferred_at,
  printf('%.3f', anomaly_score) as score_text, upper(status) as verdict, status = 'pending' as selectable from res {where}
  order by res.inferred_at desc, event_id limit {n}"""


@query(f"with res as ({_RES}) " + _RECENT.format(where="", n=50))
def recent_results(s, d):
    return results.recent(fx.results(s, d))


@query(f"with res as ({_RES}) " + _RECENT.format(where="where status = 'anomaly'", n=100))
def recent_results_by_status(s, d):
    return results.recent(fx.results(s, d), "anomaly", 100)


@query(f"""with r as ({_R}), res as ({_RES}) select event_id, model_type, res.bucket, object_key from res join r on res.model_id = r.model_id
  where status = 'pending' and event_id in (select cast(event_id as varchar) from events where event_id % 2 = 0)""")
def retrain_candidates(s, d):
    chosen = _events(s, d).where("event_id % 2 = 0").select(F.col("event_id").cast("string").alias("event_id"))
    return results.retrain_candidates(fx.results(s, d), fx.registry(s), chosen)


@query(f"""with res as ({_RES}), dom as (select unnest(['normal', 'pending', 'anomaly']) as status),
  c as (select dom.status, count(res.event_id) as n from dom left join res on res.status = dom.status group by 1)
  select status, n from c union all select 'total', sum(n)::bigint from c""")
def verdict_summary(s, d):
    return results.verdict_summary(fx.results(s, d))


@query(f"""with res as ({_RES}), c as ({fx.CLUSTERS}) select res.event_id, res.image_id, status,
  case when c.image_id is null then 'not_run' when cluster_id = -1 then 'noise' else 'cluster' end as stage, cluster_id, probability
  from res left join c on res.image_id = c.image_id""")
def result_cluster_tristate(s, d):
    return results.with_clusters(fx.results(s, d), fx.view(s, d, fx.CLUSTERS, "events"))


# Scalar expressions and events.


@query(f"""with x as (select event_id, case when event_id % 50 = 0 then 'nan'::double when event_id % 50 = 1 then {_LOW} when event_id % 50 = 2 then {_HIGH} else value / 6 end as score from events)
  select event_id, case when isnan(score) then 'pending' when score < {_LOW} then 'normal' when score > {_HIGH} then 'anomaly' else 'pending' end as status from x""")
def verdict_classify(s, d):
    k = F.col("event_id") % 50
    score = F.when(k == 0, F.lit(float("nan"))).when(k == 1, _LOW).when(k == 2, _HIGH).otherwise(F.col("value") / 6)
    return _events(s, d).select("event_id", verdict.classify(score, F.lit(_LOW), F.lit(_HIGH)).alias("status"))


_PARSED = """p as (select "offset", value, case when json_valid(value) then value end as j from m),
  f as (select "offset", json_extract_string(j, '$.event') as event, json_extract_string(j, '$.bucket') as bucket, json_extract_string(j, '$.object_key') as object_key,
    coalesce(json_extract_string(j, '$.content_type'), 'application/octet-stream') as content_type, coalesce(cast(json_extract_string(j, '$.size_bytes') as bigint), 0) as size_bytes,
    json_extract_string(j, '$.created_at') as created from p),
  g as (select *, case when event is null or bucket is null or object_key is null or created is null then concat('missing: ', concat_ws(', ',
    case when event is null then 'event' end, case when bucket is null then 'bucket' end, case when object_key is null then 'object_key' end,
    case when created is null then 'created_at' end)) end as error from f)"""


@query(f"""with m as ({fx.MESSAGES}), {_PARSED} select "offset", event, bucket, object_key, content_type, size_bytes, replace(created, 'T', ' ') as created, error from g""")
def inference_decode(s, d):
    return ev.decode_inference(fx.view(s, d, fx.MESSAGES, "events")).select(
        "offset", "event", "bucket", "object_key", "content_type", "size_bytes", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created"), "error"
    )


@query("""select event_id, concat('{"event":"inference","bucket":"images","object_key":"', event_id, '.png","content_type":"image/png","size_bytes":', event_id,
  ',"created_at":"', strftime(ts, '%Y-%m-%dT%H:%M:%S'), '"}') as value from events""")
def inference_encode(s, d):
    rows = _events(s, d).select(
        "event_id", F.lit("inference").alias("event"), F.lit("images").alias("bucket"), F.concat(F.col("event_id").cast("string"), F.lit(".png")).alias("object_key"),
        F.lit("image/png").alias("content_type"), F.col("event_id").alias("size_bytes"), F.col("ts").alias("created_at"),
    )
    return rows.select("event_id", ev.encode_inference().alias("value"))


@query(f"""with m as ({fx.MESSAGES}), {_PARSED} select case when event = 'inference' and error is null then 'taken' when error is not null then 'quarantine' else 'skipped' end as route,
  count(*) as n from g group by 1""")
def event_route(s, d):
    mine, rest = ev.route(ev.decode_inference(fx.view(s, d, fx.MESSAGES, "events")), "inference")
    named = mine.select(F.lit("taken").alias("route")).unionAll(rest.select(F.when(F.col("error").isNotNull(), "quarantine").otherwise("skipped").alias("route")))
    return named.groupBy("route").agg(F.count("*").alias("n"))


@query(r"""with x as (select page_id, concat('/', regexp_replace(url, '^[a-z]+://', '')) as path from pages),
  y as (select page_id, list_filter(string_split(path, '/'), lambda v: v <> '') as p from x)
  select page_id, case when len(p) >= 2 then p[1] end as bucket, case when len(p) >= 2 then array_to_string(p[2:], '/') end as object_key from y""")
def image_path_parse(s, d):
    p = keys.image_path(F.concat(F.lit("/"), F.regexp_replace("url", "^[a-z]+://", "")))
    return s.read.parquet(f"{d}/pages.parquet").select("page_id", p["bucket"].alias("bucket"), p["object_key"].alias("object_key"))


_KEY = "case event_id % 5 when 0 then concat('a/b/', event_type, '.', event_id, '.PNG') when 1 then concat('.hid', event_id) when 2 then concat('x', event_id) when 3 then concat('we.ird/na me', event_id, '.jpeg') else concat('k', event_id, '.') end"


@query(rf"""with x as (select event_id, {_KEY} as key from events), y as (select *, regexp_extract(key, '([^/]*)/*$', 1) as base from x),
  z as (select *, lower(regexp_extract(base, '.\.([^.]+)$', 1)) as sfx, case when regexp_matches(base, '^.+\.[^.]+$') then regexp_replace(base, '\.[^.]+$', '') else base end as stem from y)
  select event_id, stem, sfx as suffix, concat('heatmap/', stem, '.png') as heatmap_key,
  case sfx when 'png' then 'image/png' when 'jpeg' then 'image/jpeg' else 'application/octet-stream' end as content_type,
  case when key like '%.txt' then 'text/plain' else 'application/octet-stream' end as asset_type from z""")
def stem_keys(s, d):
    k = F.col("key")
    return _events(s, d).select("event_id", F.expr(_KEY).alias("key")).select(
        "event_id", keys.stem(k).alias("stem"), keys.suffix(k).alias("suffix"), keys.heatmap_key(k).alias("heatmap_key"), keys.content_type(k).alias("content_type"), keys.asset_content_type(k).alias("asset_type")
    )


@query(f"with r as ({_R}) select model_id, concat_ws('.', major_version, minor_version, patch_version) as version from r")
def semver(s, d):
    return fx.registry(s).select("model_id", keys.semver(F.col("major_version"), F.col("minor_version"), F.col("patch_version")).alias("version"))


_DEMO = """p as (select "offset", case when json_valid(value) then value end as j from m),
  q as (select "offset", json_extract_string(j, '$.event') as event, json_extract_string(j, '$.data') as data from p)"""


@query(f"""with m as ({fx.DEMO}), {_DEMO} select "offset", event, data from q""")
def stream_json_project(s, d):
    return ev.project_demo(fx.view(s, d, fx.DEMO, "events")).select("offset", "event", "data")


@query(f"""with m as ({fx.DEMO}), {_DEMO} select "offset", case when contains(lower(data), 'alert') then 1 else 0 end::int as prediction from q""")
def keyword_predict(s, d):
    return ev.project_demo(fx.view(s, d, fx.DEMO, "events")).select("offset", verdict.keyword_predict(F.col("data")).alias("prediction"))


#: A file of bounds with a line for each event: blanks, notes, both bounds over and
#: over (the last counts) and other names.
_BAND_LINES = """select event_id as line, case event_id % 5 when 0 then '' when 1 then concat('lower=', cast(cast(round(value) as bigint) as string))
  when 2 then concat('  upper =  ', cast(cast(round(value) as bigint) as string), ' ') when 3 then '# note' else concat('other=', cast(event_id as string), '=lower') end as value from events"""


@query("""select max_by(cast(round(value) as bigint), event_id) filter (where event_id % 5 = 1)::double as lower,
  max_by(cast(round(value) as bigint), event_id) filter (where event_id % 5 = 2)::double as upper from events""")
def band_parse(s, d):
    return assets.parse_band(fx.view(s, d, _BAND_LINES, "events"))


@query(f"""with res as ({_RES}) select event_id, status from res where cast(event_id as bigint) % 3 <> 0""")
def insert_if_absent(s, d):
    res = fx.results(s, d).select("event_id", "status")
    stored = res.where("cast(event_id as bigint) % 3 = 0")
    return sinks.new_rows(res.unionAll(res), stored, "event_id")


@query("""select concat('/data/', lang, '/', doc_id, '.png') as src, concat(case when doc_id % 4 = 0 then 'noise' else concat('cluster', doc_id % 4) end, '/', lang, '_', doc_id, '.png') as dst from documents""")
def cluster_manifest(s, d):
    k = F.col("doc_id") % 4
    rows = s.read.parquet(f"{d}/documents.parquet").select(F.concat(F.lit("/data/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".png")).alias("path"), F.col("lang").alias("label"), F.when(k == 0, -1).otherwise(k).cast("int").alias("cluster"))
    return sinks.cluster_manifest(rows)


# Vectors, scores and calibration.

_DIST = "list_distance(p.vec::double[], b.vec::double[])"
_NN = _ctes(p=fx.PATCHES, b=fx.BANK) + f", nn as (select image_id, patch_idx, min({_DIST}) as distance from p, b group by all)"


def _nn(s, d):
    return vectors.nearest(_patches(s, d), _bank(s, d), ["image_id", "patch_idx"])


@query(_NN + " select image_id, patch_idx, round(distance, 6) as distance from nn")
def patch_nn_distance(s, d):
    return _nn(s, d).select("image_id", "patch_idx", F.round("distance", 6).alias("distance"))


@query(_NN + " select image_id, round(max(distance), 6) as anomaly_score from nn group by 1")
def image_score(s, d):
    return vectors.image_scores(_nn(s, d)).select("image_id", F.round("anomaly_score", 6).alias("anomaly_score"))


_RANK = "(vec_id * 7919) % 1009"


@query(f"""with x as (select label as image_id, vec_id, row_number() over (partition by label order by {_RANK}, vec_id) as rn, count(*) over (partition by label) as n from embeddings)
  select image_id, vec_id from x where rn <= greatest(1, n // 20)""")
def coreset_sample(s, d):
    p = _embeddings(s, d).select(F.col("label").alias("image_id"), "vec_id")
    return vectors.coreset(p, F.struct(F.expr(_RANK), F.col("vec_id")), divisor=20).select("image_id", "vec_id")


@query(f"{_ctes(b=fx.BANK)} select count(*) as n_rows, count(distinct row_id) as n_distinct from (select row_id from b union all select vec_id from embeddings where label = 9)")
def bank_append(s, d):
    new = _embeddings(s, d).where("label = 9").select(F.col("vec_id").alias("row_id"), F.col("embedding").alias("vec"))
    return vectors.append_bank(_bank(s, d), new).agg(F.count("*").alias("n_rows"), F.countDistinct("row_id").alias("n_distinct"))


@query(f"with r as ({_R}), res as ({_RES}), {_GOOD} select round(quantile_cont(anomaly_score, 0.75), 6) as lower, round(quantile_cont(anomaly_score, 0.99), 6) as upper from good")
def calibrate_bounds(s, d):
    good = results.recent_good(fx.results(s, d), fx.registry(s), "patchcore", 200)
    return vectors.calibrate(good, (_LOW, _HIGH)).select(F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"))


@query(f"select {_LOW}::double as lower, {_HIGH}::double as upper")
def calibrate_fallback(s, d):
    return vectors.calibrate(fx.results(s, d).where("model_id = 'none'"), (_LOW, _HIGH))


@query(f"""with r as ({_R}), res as ({_RES}), {_GOOD}, z as (select quantile_cont(anomaly_score, 0.75) as lo, quantile_cont(anomaly_score, 0.99) as hi from good),
  c as (select case when anomaly_score < lo then 'normal' when anomaly_score > hi then 'anomaly' else 'pending' end as status from res, z),
  dom as (select unnest(['normal', 'pending', 'anomaly']) as status), n as (select dom.status, count(c.status) as n from dom left join c on c.status = dom.status group by 1)
  select status, n from n union all select 'total', sum(n)::bigint from n""")
def score_classify_endtoend(s, d):
    res = fx.results(s, d)
    band = vectors.calibrate(results.recent_good(res, fx.registry(s), "patchcore", 200), (_LOW, _HIGH)).first()
    return results.verdict_summary(res.withColumn("status", verdict.classify(F.col("anomaly_score"), F.lit(band.lower), F.lit(band.upper))))


@query(f"""{_ctes(p=fx.PATCHES, b=fx.BANK)}, fresh as (select vec, row_number() over (order by patch_idx) as rn from p where image_id = (select max(image_id) from p)),
  good as (select image_id from p where image_id % 3 <> 0), nn as (select image_id, patch_idx, min({_DIST}) as dist from p, b where image_id % 3 <> 0 and image_id < (select max(image_id) from p) group by all),
  sc as (select image_id, max(dist) as x from nn group by 1)
  select '1.10.4' as version, (select count(*) from b) + 1 as bank_rows, count(*) as scored, true as band_ordered from sc""")
def retrain_candidate(s, d):
    p = _patches(s, d)
    newest = p.agg(F.max("image_id")).first()[0]
    res = p.where(f"image_id % 3 <> 0 and image_id < {newest}").select(F.col("image_id").cast("string").alias("image_id")).distinct().select("image_id", F.col("image_id").alias("event_id"), F.lit("m3").alias("model_id"), F.lit("normal").alias("status"), F.lit("2024-01-01").cast("timestamp").alias("inferred_at"), F.col("image_id").alias("object_key"))
    text = p.withColumn("image_id", F.col("image_id").cast("string"))
    c = retrain(fx.registry(s), res, _bank(s, d), text.where(F.col("image_id") == str(newest)), text.where(F.col("image_id") != str(newest)), (_LOW, _HIGH), "patchcore", 10**6)
    return c.bank.agg(F.count("*").alias("bank_rows")).select(F.lit(".".join(map(str, c.version))).alias("version"), "bank_rows", F.lit(res.count()).cast("long").alias("scored"), F.lit(c.band.selectExpr("lower <= upper").first()[0]).alias("band_ordered"))


@query("""with x as (select vec_id, embedding::double[] as v, sqrt(list_sum(list_transform(embedding::double[], lambda e: e * e))) as n from embeddings)
  select vec_id, round(n, 6) as norm, round(list_sum(list_transform(v, lambda e: (e / n) * (e / n))), 6) as unit, round(v[1] / n, 6) as first from x""")
def l2_normalise(s, d):
    u = vectors.l2_normalise(F.col("embedding"))
    return _embeddings(s, d).select("vec_id", F.round(vectors.norm(F.col("embedding")), 6).alias("norm"), u.alias("u")).select(
        "vec_id", "norm", F.round(F.aggregate("u", F.lit(0.0), lambda a, x: a + x * x), 6).alias("unit"), F.round(F.col("u")[0], 6).alias("first")
    )


_LONG = "select vec_id, label, embedding, unnest(embedding)::double as x, generate_subscripts(embedding, 1) - 1 as channel from embeddings"
_STATS = f"l as ({_LONG}), st as (select channel, avg(x) as mu, sqrt(greatest(avg(x * x) - avg(x) * avg(x), 1e-6)) as sigma from l where label <= 4 and vec_id % 2 = 0 group by 1)"


@query(f"with {_STATS} select channel::int as channel, round(mu, 6) as mu, round(sigma, 6) as sigma from st")
def prototype_stats(s, d):
    return descriptors.prototype(_bank(s, d)).select("channel", F.round("mu", 6).alias("mu"), F.round("sigma", 6).alias("sigma"))


_COS = _ctes(p=fx.PATCHES, b=fx.BANK) + """, cs as (select p.vec_id, list_cosine_similarity(p.vec::double[], b.vec::double[]) as c from p, b),
  top as (select *, row_number() over (partition by vec_id order by c desc) as rn from cs), k as (select vec_id, 1 - avg(c) as score from top where rn <= {k} group by 1)"""


@query(_COS.format(k=3) + " select vec_id, round(score, 6) as score from k")
def cosine_score(s, d):
    return vectors.nearest(_patches(s, d), _bank(s, d), ["vec_id"], "cosine", 3).select("vec_id", F.round("distance", 6).alias("score"))


@query(f"with {_STATS} select vec_id, round(sqrt(sum(((x - mu) / sigma) * ((x - mu) / sigma))), 5) as z from l join st on l.channel = st.channel group by 1")
def zscore_score(s, d):
    a = descriptors.prototype_arrays(descriptors.prototype(_bank(s, d))).first()
    arr = lambda v: F.array(*map(F.lit, v))
    return _embeddings(s, d).select("vec_id", F.round(descriptors.zscore(F.col("embedding"), arr(a.mu), arr(a.sigma)), 5).alias("z"))


_POOL = _COS.format(k=1) + """, w as (select p.image_id, p.vec, pow(greatest(score, 0), 3) as w from p join k on p.vec_id = k.vec_id),
  t as (select image_id, sum(w) + 1e-8 as t from w group by 1), lw as (select image_id, w, unnest(vec)::double as x, generate_subscripts(vec, 1) - 1 as channel from w),
  po as (select lw.image_id, channel, sum(x * w) / any_value(t) as pooled, avg(x) as mean from lw join t on lw.image_id = t.image_id group by 1, 2)"""


def _pooled(s, d):
    p = _patches(s, d)
    scored = p.join(vectors.nearest(p, _bank(s, d), ["vec_id"], "cosine").withColumnRenamed("distance", "score"), "vec_id")
    return descriptors.weighted_pool(scored, ["image_id"])


@query(_POOL + " select image_id, channel::int as channel, round(pooled, 6) as pooled from po")
def weighted_pool(s, d):
    return _pooled(s, d).select("image_id", "channel", F.round("pooled", 6).alias("pooled"))


@query(_POOL + f", {_STATS} select image_id, po.channel::int as channel, round(mean - mu, 6) as residual, round(pooled - mu, 6) as weighted_residual from po join st on po.channel = st.channel")
def residual_pool(s, d):
    p, st = _pooled(s, d), descriptors.prototype(_bank(s, d))
    a = descriptors.residual(p, st, "residual").select("image_id", "channel", F.round("value", 6).alias("residual"))
    b = descriptors.residual(p, st).select("image_id", "channel", F.round("value", 6).alias("weighted_residual"))
    return a.join(b, ["image_id", "channel"])


@query(_POOL + """, lv as (select image_id, channel % 2 as level, channel, pooled from po), n as (select image_id, level, greatest(sqrt(sum(pooled * pooled)), 1e-12) as n from lv group by all)
  select lv.image_id, count(*) as dims, round(sum(pooled / n.n * pooled / n.n), 6) as squares, round(arg_min(pooled / n.n, (lv.level, lv.channel)), 6) as first
  from lv join n on lv.image_id = n.image_id and lv.level = n.level group by 1""")
def deep_vector(s, d):
    rows = _pooled(s, d).select("image_id", (F.col("channel") % 2).alias("level"), "channel", F.col("pooled").alias("value"))
    return descriptors.deep_vectors(rows, ["image_id"]).select("image_id", F.size("deep").cast("long").alias("dims"), F.round(F.aggregate("deep", F.lit(0.0), lambda a, x: a + x * x), 6).alias("squares"), F.round(F.col("deep")[0], 6).alias("first"))


@query("""with px as (select user_id, extract(hour from ts)::int as x, extract(minute from ts)::int as y, value as score from events),
  m as (select user_id, min(score) as m from px group by 1), w as (select px.*, score - m + 1e-6 as w from px join m on px.user_id = m.user_id),
  c as (select user_id, count(*) as n, sum(w) as sw, sum(w * x) / sum(w) as cx, sum(w * y) / sum(w) as cy from w group by 1),
  mo as (select w.user_id, any_value(n) as n, sum(w * (x - cx) * (x - cx)) / any_value(sw) as xx, sum(w * (y - cy) * (y - cy)) / any_value(sw) as yy, sum(w * (x - cx) * (y - cy)) / any_value(sw) as xy
    from w join c on w.user_id = c.user_id group by 1),
  e as (select *, (xx + yy) / 2 as h, sqrt(((xx - yy) / 2) * ((xx - yy) / 2) + xy * xy) as r from mo)
  select user_id, round(case when n < 5 then 1.0::double else sqrt(greatest(h + r, 1e-9) / greatest(h - r, 1e-9)) end, 5) as elongation from e""")
def elongation(s, d):
    px = _events(s, d).select("user_id", F.hour("ts").alias("x"), F.minute("ts").alias("y"), F.col("value").alias("score"))
    return descriptors.elongation(px, ["user_id"]).select("user_id", F.round("elongation", 5).alias("elongation"))


# Fusion and refinement.


@query(f"with l as ({_LONG}), m as (select channel, avg(x) as mu, stddev_pop(x) as sd from l group by 1) select vec_id, l.channel::int as channel, round((x - mu) / sd * 0.3 / sqrt(len(embedding)), 6) + 0.0::double as value from l join m on l.channel = m.channel")
def block_prep(s, d):
    return fusion.block_prep(_embeddings(s, d), "vec_id", "embedding", 0.3).select("vec_id", "channel", (F.round("value", 6) + F.lit(0.0)).alias("value"))


_SPLIT = """e as (select {g} as g, {v}::double as x, {i} as i from {t}), o as (select *, row_number() over w as rn, sum(x) over w as s, sum(x * x) over w as q, lead(x) over (partition by g order by x, i) as nx,
    count(*) over (partition by g) as n, sum(x) over (partition by g) as ts, sum(x * x) over (partition by g) as tq from e window w as (partition by g order by x, i rows unbounded preceding)),
  c as (select g, rn, round(q - s * s / rn + (tq - q) - (ts - s) * (ts - s) / (n - rn), 9) as sse from o where nx > x),
  b as (select g, arg_min(rn, (sse, rn)) as cut from c group by 1), h as (select o.*, coalesce(rn > cut, false) as high from o left join b on o.g = b.g)"""


@query("with " + _SPLIT.format(g="event_type", v="round(value, 2)", i="event_id", t="events") + """ select g as event_type, count(*) filter (not high) as n_low, count(*) filter (high) as n_high,
  round(avg(x) filter (not high), 6) as mean_low, round(avg(x) filter (high), 6) as mean_high from h group by 1""")
def kmeans1d_split(s, d):
    rows = _events(s, d).select("event_type", F.round("value", 2).alias("v"), "event_id")
    return fusion.split_1d(rows, "event_type", "v", "event_id").groupBy("event_type").agg(*(F.first(c).cast("long").alias(c) for c in ("n_low", "n_high")), *(F.round(F.first(c), 6).alias(c) for c in ("mean_low", "mean_high")))


_SHAPES = "select vec_id as item_id, case when vec_id % 29 = 0 then -1 else label end as cluster, case when (vec_id * 7) % (label + 3) = 0 then 0.2 else 0.8 end + (vec_id % 10) / 100.0 as ecc, label * 0.1 + (vec_id % 7) / 100.0 as color_mag from embeddings"


@query(f"with s as ({_SHAPES}), live as (select * from s where cluster <> -1), {_SPLIT.format(g='cluster', v='ecc', i='item_id', t='live')}," + f"""
  mag as (select cluster as g, avg(color_mag) as mag from live group by 1), md as (select quantile_cont(mag, 0.5) as md from mag),
  per as (select h.g, count(*) as n, count(*) filter (not high) as nl, count(*) filter (high) as nh, avg(x) filter (high) - avg(x) filter (not high) as gap from h group by 1),
  ok as (select per.*, least(nl, nh) as mi from per join mag on per.g = mag.g, md where n >= {2 * fusion.MIN_SUB} and gap >= {fusion.SPLIT_GAP} and least(nl, nh) >= greatest({fusion.MIN_SUB}, {fusion.BALANCE} * n) and mag <= md),
  ch as (select * from ok order by mi desc, g limit 1), mv as (select h.i from h join ch on h.g = ch.g and high = (nh <= nl))
  select item_id, cluster, case when item_id in (select i from mv) then (select max(cluster) + 1 from s) else cluster end as refined from s""")
def refine(s, d):
    return fusion.refine(fx.view(s, d, _SHAPES, "embeddings").withColumn("ecc", F.col("ecc").cast("double")).withColumn("color_mag", F.col("color_mag").cast("double"))).select("item_id", "cluster", "refined")


# Clustering benchmark, on clusters made from labels by a fixed rule.

_CL = "select vec_id as item_id, embedding as vec, case when vec_id % 23 = 0 then -1 when vec_id % 5 = 0 then (label + 3) % 8 else label % 8 end as predicted, label as truth from embeddings"
_CELLS = f"""cl as ({_CL}), c as (select predicted as p, truth as t, count(*)::double as n from cl where predicted <> -1 group by 1, 2), a as (select p, sum(n) as a from c group by 1),
  b as (select t, sum(n) as b from c group by 1), tot as (select sum(n) as total from c), x as (select c.*, a, b, total from c join a on c.p = a.p join b on c.t = b.t, tot)"""
_INFO = f"""{_CELLS}, i as (select sum(n / total * ln(n * total / (a * b))) as mi, (select -sum(a / total * ln(a / total)) from a, tot) as hp, (select -sum(b / total * ln(b / total)) from b, tot) as ht from x)"""


def _clustering(s, d):
    return fx.view(s, d, _CL, "embeddings")


@query(f"with cl as ({_CL}) select count(*) as n, count(distinct truth) as classes, count(distinct predicted) filter (predicted <> -1) as clusters, count(*) filter (predicted = -1) as noise, round(count(*) filter (predicted <> -1) / count(*), 6) as coverage from cl")
def bench_counts(s, d):
    return metrics.counts(_clustering(s, d))


@query(f"with {_CELLS} select a.p as cluster, t.t as class, coalesce(c.n, 0)::bigint as n from a cross join (select distinct truth as t from cl) t left join c on c.p = a.p and c.t = t.t")
def contingency(s, d):
    return metrics.contingency(_clustering(s, d))


_PAIRS = f"""{_CELLS}, k as (select sum(n * (n - 1) / 2) as s, (select sum(a * (a - 1) / 2) from a) as sa, (select sum(b * (b - 1) / 2) from b) as sb, any_value(total * (total - 1) / 2) as e from x)"""


@query(f"with {_PAIRS} select round((s - sa * sb / e) / ((sa + sb) / 2 - sa * sb / e), 6) as ari from k")
def ari(s, d):
    return metrics.pair_metrics(metrics.cells(_clustering(s, d))).select("ari")


@query(f"with {_PAIRS} select round(s / sqrt(sa * sb), 6) as fmi from k")
def fmi(s, d):
    return metrics.pair_metrics(metrics.cells(_clustering(s, d))).select("fmi")


@query(f"with {_INFO} select round(2 * mi / (hp + ht), 6) as nmi from i")
def nmi(s, d):
    return metrics.information_metrics(metrics.cells(_clustering(s, d))).select("nmi")


@query(f"with {_INFO} select round(mi / ht, 6) as homogeneity, round(mi / hp, 6) as completeness, round(2 * mi / (hp + ht), 6) as v_measure from i")
def homogeneity_vmeasure(s, d):
    return metrics.information_metrics(metrics.cells(_clustering(s, d))).select("homogeneity", "completeness", "v_measure")


@query(f"""with {_INFO}, ab as (select a, b, total from a, b, tot), l as (select a, b, total, unnest(range(greatest(1, (a + b - total)::bigint), least(a, b)::bigint + 1)) as k from ab),
  e as (select sum(k / total * ln(total * k / (a * b)) * exp(lgamma(a + 1) + lgamma(b + 1) + lgamma(total - a + 1) + lgamma(total - b + 1) - lgamma(total + 1) - lgamma(k + 1)
    - lgamma(a - k + 1) - lgamma(b - k + 1) - lgamma(total - a - b + k + 1))) as emi from l)
  select round((mi - emi) / ((hp + ht) / 2 - emi), 6) as ami from i, e""")
def ami(s, d):
    return metrics.adjusted_mutual_information(metrics.cells(_clustering(s, d)))


@query(f"with {_CELLS} select round(sum(m) / any_value(total), 6) as purity from (select p, max(n) as m, any_value(total) as total from x group by 1)")
def purity(s, d):
    return metrics.purity(metrics.cells(_clustering(s, d)))


@query(f"with {_CELLS} select p as cluster, sum(n)::bigint as size, arg_min(t, (-n, t)) as main_class, round(max(n) / sum(n), 2) as purity from c group by 1")
def main_classes(s, d):
    return metrics.main_classes(_clustering(s, d))


_SMALL = "select vec_id as item_id, case when vec_id % 7 = 0 then (label + 1) % 5 else label % 5 end as predicted, label % 5 as truth from embeddings"


@query(f"""with recursive cl as ({_SMALL}), m as (select p, t, coalesce(n, 0) as n from range(5) a(p), range(5) b(t) left join (select predicted, truth, count(*) as n from cl group by 1, 2) c on c.predicted = p and c.truth = t),
  g(step, used, total) as (select 0, [9999]::bigint[], 0::bigint union all select step + 1, list_append(used, m.t), total + m.n from g join m on m.p = g.step and not list_contains(used, m.t) where step < 5)
  select round(max(total) / (select count(*) from cl), 6) as hungarian from g where step = 5""")
def hungarian(s, d):
    c = metrics.cells(fx.view(s, d, _SMALL, "embeddings"))
    return s.createDataFrame([(round(metrics.hungarian_accuracy(c), 6),)], "hungarian double")


@query(f"""with cl as (select * from ({_CL}) where predicted <> -1), q as (select a.item_id, a.predicted as c, b.predicted as o, list_distance(a.vec::double[], b.vec::double[]) as d from cl a, cl b),
  k as (select item_id, c, o, sum(d) as s, count(*) as n from q group by all), r as (select item_id, max(case when c = o and n > 1 then s / (n - 1) end) as a, min(case when c <> o then s / n end) as b from k group by 1)
  select round(avg(coalesce((b - a) / greatest(a, b), 0)), 6) as silhouette from r""")
def silhouette(s, d):
    return metrics.silhouette(_clustering(s, d), "item_id", "predicted", "vec").agg(F.round(F.avg("silhouette"), 6).alias("silhouette"))


@query(f"""with cl as (select item_id, predicted as c, vec::double[] as v from ({_CL}) where predicted <> -1), l as (select item_id, c, unnest(v) as x, generate_subscripts(v, 1) as i from cl),
  pm as (select c, i, avg(x) as m, count(*) as n from l group by 1, 2), ce as (select c, list(m order by i) as m, max(n) as n from pm group by 1),
  sp as (select cl.c, avg(list_distance(v, m)) as s, sum(pow(list_distance(v, m), 2)) as w from cl join ce on cl.c = ce.c group by 1), k as (select ce.*, s, w from ce join sp on ce.c = sp.c),
  db as (select avg(r) as db from (select a.c, max((a.s + b.s) / list_distance(a.m, b.m)) as r from k a join k b on a.c <> b.c group by 1)),
  gm as (select i, avg(x) as g from l group by 1), be as (select sum(n * (m - g) * (m - g)) as b from pm join gm on pm.i = gm.i), wi as (select sum(w) as w, count(*) as k, sum(n) as n from k)
  select round(db, 6) as davies_bouldin, round(b * (n - k) / (w * (k - 1)), 6) as calinski_harabasz from db, be, wi""")
def db_ch(s, d):
    return metrics.centroid_metrics(_clustering(s, d), "predicted", "vec")


@query(f"with cl as ({_CL}) select predicted as cluster, count(*) as size from cl group by 1")
def cluster_sizes(s, d):
    return metrics.cluster_sizes(_clustering(s, d))


# Without SQL: rasters and iterative algorithms, tested against numpy and golden values.


def _maps(s, d):
    """Score maps of 8 x 8 from the vectors."""
    return _embeddings(s, d).select(F.col("vec_id").alias("image_id"), F.lit(8).alias("h"), F.lit(8).alias("w"), F.transform(F.col("embedding").cast("array<double>"), lambda x: x * x).alias("values"))


def _tiles(s, d, side: int):
    """Score maps of ``side`` x ``side`` vectors, each 8 x 8 pixels, with colours;
    places without a vector hold zeros."""
    n, w = side * side, 8 * side
    vecs = F.struct((F.col("vec_id") % n).alias("k"), F.transform(F.col("embedding").cast("array<double>"), lambda x: x * x).alias("v"))
    found = _embeddings(s, d).groupBy(F.floor(F.col("vec_id") / n).alias("image_id")).agg(F.map_from_entries(F.collect_list(vecs)).alias("m"))
    line, col = lambda i: F.floor(i / w), lambda i: i % w
    tile = lambda i: F.floor(line(i) / 8) * side + F.floor(col(i) / 8)
    within = lambda i: (line(i) % 8 * 8 + col(i) % 8).cast("int")
    values = F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(w * w - 1).cast("bigint")), lambda i: F.coalesce(F.get(F.element_at("m", tile(i)), within(i)), F.lit(0.0)))
    maps = found.select("image_id", F.lit(8 * side).alias("h"), F.lit(8 * side).alias("w"), values.alias("values"))
    return maps.withColumn("rgb", F.flatten(F.transform("values", lambda v: F.array(v, v * v, F.lit(1.0) - v))))


def _rounded(described: DataFrame) -> DataFrame:
    return described.select("image_id", "mask_pixels", *(F.round(c, 6).alias(c) for c in (*regions.COLOR, *regions.SHAPE)))


@query(masks_sql("select vec_id as image_id, (i - 1) // 8 as y, (i - 1) % 8 as x, embedding[i]::double * embedding[i]::double as v from embeddings, range(1, 65) t(i)", 8, "v", "v", "v"))
def mask_color_shape(s, d):
    return _rounded(regions.describe(_maps(s, d)))


@query(masks_sql("""select image_id, y, x, coalesce(v, 0) as v from (select image_id, y, x from (select distinct vec_id // 25 as image_id from embeddings), range(40) a(y), range(40) b(x)) left join
  (select vec_id // 25 as image_id, vec_id % 25 // 5 * 8 + (i - 1) // 8 as y, vec_id % 5 * 8 + (i - 1) % 8 as x, embedding[i]::double * embedding[i]::double as v from embeddings, range(1, 65) t(i)) using (image_id, y, x)""", 40, "v", "v * v", "1 - v"))  # fmt: skip
def mask_regions(s, d):
    return _rounded(regions.describe(_tiles(s, d, 5), pixels="rgb"))


@query(f"""with o as (select greatest((i + 0.5) * 8 / 224 - 0.5, 0) as u from range(224) t(i)), f as (select least(floor(u), 7)::int as lo, u - least(floor(u), 7) as part from o),
  w as (select i, sum(w) as w from (select lo as i, 1 - part as w from f union all select least(lo + 1, 7), part from f) group by 1),
  m as (select vec_id, unnest(embedding::double[]) as v, generate_subscripts(embedding, 1) - 1 as k from embeddings)
  select vec_id as image_id, 50176::bigint as pixels, round(sum(v * v * y.w * x.w), 4) as mass, {0.8 * _LOW!r}::double as scale_low, {1.2 * _HIGH!r}::double as scale_high
  from m join w y on y.i = k // 8 join w x on x.i = k % 8 group by 1""")
def heatmap_upsample(s, d):
    return descriptors.heatmaps(_maps(s, d), _LOW, _HIGH).select("image_id", F.size("heat").cast("long").alias("pixels"), F.round(F.aggregate("heat", F.lit(0.0), lambda a, x: a + x), 4).alias("mass"), "scale_low", "scale_high")


@query()
def kernel_pca(s, d):
    return fusion.kernel_pca(_embeddings(s, d).select("vec_id", "embedding"), "vec_id", "embedding")


_PAIR_SQL = "with x as (select vec_id, embedding::double[] as v from embeddings), l as (select vec_id, i, v[i] as v, v[i] / sqrt(list_sum(list_transform(v, lambda e: e * e))) as u from x, unnest(range(1, len(v) + 1)) as t(i)), m as (select i, avg(u) as m from l group by 1)"


def _neighbouring(df: DataFrame) -> DataFrame:
    """Rows beside those of the next id."""
    return df.alias("a").join(df.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec").alias("next")), "vec_id")


@query(f"{_PAIR_SQL} select a.vec_id, round(sum((a.u - m) * (b.u - m)), 6) as gram from l a join l b on b.vec_id = a.vec_id + 1 and a.i = b.i join m on a.i = m.i group by 1")
def kernel_pca_gram(s, d):
    """Products of all components are entries of the centred cosine kernel."""
    rows = _embeddings(s, d).select("vec_id", "embedding")
    pairs = _neighbouring(fusion.kernel_pca(rows, "vec_id", "embedding", 10**6))
    return pairs.select("vec_id", F.round(F.aggregate(F.zip_with("vec", "next", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x), 6).alias("gram"))


@query(f"{_PAIR_SQL} select a.vec_id, round(sum((a.v - b.v) * (a.v - b.v)), 6) as square from l a join l b on b.vec_id = a.vec_id + 1 and a.i = b.i group by 1")
def pca_distances(s, d):
    """All components keep the distances."""
    rows = _embeddings(s, d).select("vec_id", "embedding")
    pairs = _neighbouring(fusion.project(rows, "vec_id", "embedding", *fusion.fit_pca(rows, "embedding", 2.0)))
    return pairs.select("vec_id", F.round(F.aggregate(F.zip_with("vec", "next", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x), 6).alias("square"))


@query()
def pca_variance(s, d):
    rows = _embeddings(s, d).select("vec_id", "embedding")
    return fusion.project(rows, "vec_id", "embedding", *fusion.fit_pca(rows, "embedding"))


@query()
def hdbscan(s, d):
    return cluster.hdbscan(_embeddings(s, d).select("vec_id", "embedding"), "vec_id", "embedding")


@query()
def hdbscan_forest(s, d):
    """The same clusters from a neighbour forest, at linear cost."""
    return density.fit(_embeddings(s, d), "vec_id", "embedding", trees=neighbours.TREES).select("vec_id", "cluster", "probability")


@query()
def umap_layout(s, d):
    return cluster.umap(_embeddings(s, d).select("vec_id", "embedding"), "vec_id", "embedding")


@query()
def cluster_assign(s, d):
    """Fit on the bank's rows, then assign every vector."""
    rows = _embeddings(s, d).select("vec_id", F.col("embedding").alias("vec"))
    return density.assign(rows, density.fit(_bank(s, d), "row_id", "vec"), "vec_id", "vec")


def _experiment(s, d, shape_block):
    p = _patches(s, d)
    values = F.transform(F.min_by("vec", "patch_idx").cast("array<double>"), lambda x: x * x)
    maps = p.groupBy("image_id").agg(values.alias("values")).select("image_id", F.lit(8).alias("h"), F.lit(8).alias("w"), "values")
    # Two levels of every patch: the vector, and its channels the other way round.
    levels = lambda rows, *keys: rows.select(*keys, F.lit("a").alias("level"), "vec").unionByName(rows.select(*keys, F.lit("b").alias("level"), F.reverse("vec").alias("vec")))
    patches, bank = levels(p, "image_id", "patch_idx"), levels(_bank(s, d))
    return clustering.experiment_of_maps(patches, bank, maps, shape_block=shape_block)


@query()
def experiment_clusters(s, d):
    """Both clustering layers from patches of two levels and score maps."""
    return _experiment(s, d, False)


@query()
def experiment_clusters_shape(s, d):
    """The variant with a block of shapes and rows of unit length."""
    return _experiment(s, d, True)
