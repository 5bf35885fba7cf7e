"""Queries of the entity operators: history, activity, convergence, novelty, composition, geography, lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import entities as E
from tidemark.operators.pages import cursors_of, numbered
from tidemark.operators.revisions import heads, latest, reconcile
from tidemark.plans.bindings import EVENTS, OBSERVATIONS, SOURCES, events, observations, sources, stamp, table
from tidemark.plans.registry import query

S = "'%Y-%m-%d %H:%M:%S'"
CONTEXT = ["CONTEXT_KNOWLEDGE"]


def contributing(spark, d):
    return E.contributing(observations(spark, d), sources(spark, d), context_classes=CONTEXT)


OWN = f"{OBSERVATIONS}, own AS (SELECT * FROM obs WHERE source_class <> 'CONTEXT_KNOWLEDGE')"
ROWS = f"""{OWN}, ac AS (SELECT 'DAY' AS granularity, date_trunc('day', t0) AS b, * FROM own UNION ALL SELECT 'HOUR', date_trunc('hour', t0), * FROM own WHERE observed_time IS NOT NULL)"""


@query("contributing_observations", f"WITH {OWN} SELECT source_key, origin, source_class, count(*) AS n FROM own GROUP BY 1, 2, 3")
def contributing_observations(spark, d):
    """Observations without context-only classes."""
    return contributing(spark, d).groupBy("source_key", "origin", "source_class").agg(F.count("*").alias("n"))


@query(
    "entity_history",
    f"""WITH {OBSERVATIONS} SELECT entity_key, strftime(min(t0), {S}) AS first_seen, strftime(max(t0), {S}) AS last_seen, arg_min(source_key, (t0, observation_key)) AS first_source, arg_max(source_key, (t0, observation_key)) AS last_source,
    count(*) AS observations, count(DISTINCT source_key) AS sources FROM obs GROUP BY 1""",
)
def entity_history(spark, d):
    """First and last sight of every entity."""
    out = E.entity_history(observations(spark, d))
    return out.select("entity_key", stamp("first_seen").alias("first_seen"), stamp("last_seen").alias("last_seen"), "first_source", "last_source", "observations", "sources")


@query(
    "entity_activity",
    f"""WITH {ROWS} SELECT entity_key, granularity, strftime(b, {S}) AS bucket, count(*) AS observations, count(DISTINCT source_key) AS sources, count(DISTINCT origin) AS origins, count(DISTINCT source_class) AS classes,
    count(observed_time) AS instants, count(observed_date) AS dates FROM ac GROUP BY 1, 2, 3""",
)
def entity_activity(spark, d):
    """Hour and day activity of every entity."""
    out = E.entity_activity(contributing(spark, d))
    return out.select("entity_key", "granularity", stamp("bucket_start").alias("bucket"), "observations", "sources", "origins", "classes", "instants", "dates")


@query(
    "activity_members",
    f"""WITH {ROWS} SELECT entity_key, granularity, strftime(b, {S}) AS bucket, source_key, count(*) AS observations, CASE WHEN count(observed_date) = 0 THEN strftime(min(observed_time), {S}) END AS first_time,
    CASE WHEN count(observed_date) = 0 THEN strftime(max(observed_time), {S}) END AS last_time FROM ac GROUP BY 1, 2, 3, 4""",
)
def activity_members(spark, d):
    """Sources of each activity bucket; times only of pure instants."""
    out = E.activity_members(contributing(spark, d))
    return out.select("entity_key", "granularity", stamp("bucket_start").alias("bucket"), "source_key", "observations", stamp("first_time").alias("first_time"), stamp("last_time").alias("last_time"))


FINDINGS = f"""{ROWS}, act AS (SELECT entity_key, granularity, b, count(*) AS observations, count(DISTINCT source_key) AS s, count(DISTINCT origin) AS o, count(DISTINCT source_class) AS c, count(observed_date) AS dt, floor((epoch_us(max(observed_time)) - epoch_us(min(observed_time))) / 1000000) AS span FROM ac GROUP BY 1, 2, 3),
  fi AS (SELECT *, 'SOURCE_SYSTEM_OVERLAP' AS finding FROM act WHERE s >= 2 UNION ALL SELECT *, 'MULTI_ORIGIN_CONVERGENCE' FROM act WHERE o >= 2 UNION ALL SELECT *, 'CROSS_CLASS_CONVERGENCE' FROM act WHERE c >= 2 UNION ALL SELECT *, 'CONCURRENT_MOVEMENT' FROM act WHERE dt = 0 AND o >= 2 AND span <= 3600)"""


@query("convergence_findings", f"WITH {FINDINGS} SELECT entity_key, granularity, strftime(b, {S}) AS bucket, finding, CAST(CASE WHEN dt = 0 THEN span END AS BIGINT) AS span_s FROM fi")
def convergence(spark, d):
    """Several sources, origins or classes at one time."""
    out = E.convergence(E.entity_activity(contributing(spark, d)), 3600)
    return out.select("entity_key", "granularity", stamp("bucket_start").alias("bucket"), "finding", "span_s")


@query("discovery_summary", f"WITH {FINDINGS} SELECT finding, count(*) AS n, count(DISTINCT entity_key) AS entities FROM fi GROUP BY 1")
def discovery_summary(spark, d):
    return E.discovery_summary(E.convergence(E.entity_activity(contributing(spark, d)), 3600))


@query(
    "top_movers",
    f"WITH {FINDINGS} SELECT entity_key, granularity, strftime(b, {S}) AS bucket, observations FROM act WHERE granularity = 'DAY' ORDER BY observations DESC, o DESC, s DESC, b DESC, entity_key DESC LIMIT 10",
)
def top_movers(spark, d):
    """The ten busiest entity days (a report of a fixed length)."""
    out = E.top_movers(E.entity_activity(contributing(spark, d)).where("granularity = 'DAY'"), 10)
    return out.select("entity_key", "granularity", stamp("bucket_start").alias("bucket"), "observations")


@query(
    "novelty_classification",
    f"""WITH {OBSERVATIONS}, h AS (SELECT entity_key, min(t0) AS f FROM obs GROUP BY 1) SELECT CASE WHEN f >= TIMESTAMP '2024-01-02' THEN 'NEW_ENTITY' ELSE 'HISTORICAL_DISCOVERY' END AS finding, count(*) AS n FROM h GROUP BY 1""",
)
def novelty(spark, d):
    """First sights after the bootstrap day are new, earlier ones a discovery of history."""
    h = E.entity_history(observations(spark, d))
    basis = F.when(F.col("first_seen") >= F.lit("2024-01-02").cast("timestamp"), "LIVE_INCREMENTAL").otherwise("INITIAL_BOOTSTRAP")
    return E.novelty(h.withColumn("first_basis", basis)).groupBy("finding").agg(F.count("*").alias("n"))


@query(
    "novelty_facts",
    f"""WITH {OBSERVATIONS}, h AS (SELECT entity_key, min(t0) AS f, arg_min(source_key, (t0, observation_key)) AS s FROM obs GROUP BY 1) SELECT entity_key, strftime(f, {S}) AS event_time FROM h WHERE s = 'click'""",
)
def novelty_facts(spark, d):
    """Novelty facts of one source: the entities that it saw first."""
    return E.novelty_facts(E.entity_history(observations(spark, d)), "click").select("entity_key", stamp("event_time").alias("event_time"))


COMPOSITION = f"""{ROWS}, st AS (SELECT entity_key, b, list_sort(list_distinct(list(source_key))) AS s, list_sort(list_distinct(list(origin))) AS o, list_sort(list_distinct(list(source_class))) AS c FROM ac WHERE granularity = 'DAY' GROUP BY 1, 2),
    x AS (SELECT n.entity_key, n.b, list_filter(n.s, lambda v: NOT list_contains(coalesce(p.s, []), v)) AS ns, list_filter(n.o, lambda v: NOT list_contains(coalesce(p.o, []), v)) AS no, list_filter(n.c, lambda v: NOT list_contains(coalesce(p.c, []), v)) AS nc
      FROM st n LEFT JOIN st p ON p.entity_key = n.entity_key AND p.b = n.b - INTERVAL 1 DAY)"""


@query(
    "composition_expansion",
    f"""WITH {COMPOSITION}, old AS (SELECT DISTINCT entity_key, date_trunc('day', t0) AS b FROM own WHERE entity_key % 3 = 0), f AS (SELECT * FROM x WHERE len(ns) > 0)
    SELECT entity_key, strftime(b, {S}) AS bucket, array_to_string(ns, ',') AS new_sources, array_to_string(no, ',') AS new_origins, 'ACTIVE' AS state FROM f
    UNION ALL SELECT entity_key, strftime(b, {S}), '', '', 'RETRACTED' FROM old WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.entity_key = old.entity_key AND f.b = old.b)""",
)
def composition(spark, d):
    """Sources and origins that the day before didn't have, and old findings (every day of some entities) that hold no more."""
    own = contributing(spark, d)
    at = F.coalesce("observed_time", F.col("observed_date").cast("timestamp"))
    active = own.where("entity_key % 3 = 0").select("entity_key", F.date_trunc("day", at).alias("bucket_start")).distinct()
    out = E.composition(E.activity_members(own), "DAY", active)
    return out.select("entity_key", stamp("bucket_start").alias("bucket"), F.array_join("new_sources", ",").alias("new_sources"), F.array_join("new_origins", ",").alias("new_origins"), "state")


@query(
    "expansion_movers",
    f"WITH {COMPOSITION} SELECT entity_key, strftime(b, {S}) AS bucket, len(no) AS n_origins, len(nc) AS n_classes, len(ns) AS n_sources FROM x WHERE len(ns) > 0 ORDER BY len(no) DESC, len(nc) DESC, len(ns) DESC, b DESC, entity_key DESC LIMIT 10",
)
def expansion_movers(spark, d):
    """The ten largest expansions (a report of a fixed length)."""
    out = E.expansion_movers(E.composition(E.activity_members(contributing(spark, d)), "DAY"))
    count = lambda c: F.col(c).cast("bigint").alias(c)
    return out.select("entity_key", stamp("bucket_start").alias("bucket"), count("n_origins"), count("n_classes"), count("n_sources"))


NOVEL = """nv AS (SELECT user_id, event_id, ts, CASE event_type WHEN 'click' THEN 'THREATFOX' WHEN 'view' THEN 'MALWAREBAZAAR' ELSE 'OTHER' END AS source_key, CASE user_id % 4 WHEN 0 THEN 'IP' WHEN 1 THEN 'HASH' WHEN 2 THEN 'HASH' ELSE 'MALWARE' END AS entity_type,
  CASE WHEN user_id % 4 = 1 THEN 'sha256:' || user_id ELSE CAST(user_id AS VARCHAR) END AS entity_key FROM events),
  hb AS (SELECT entity_type, entity_key, min(ts) AS t, arg_min(source_key, (ts, event_id)) AS s FROM nv WHERE event_id % 2 = 0 GROUP BY 1, 2), ha AS (SELECT entity_type, entity_key, min(ts) AS t, arg_min(source_key, (ts, event_id)) AS s FROM nv GROUP BY 1, 2),
  mb AS (SELECT *, CASE WHEN s = 'THREATFOX' AND entity_type IN ('IP', 'DOMAIN', 'URL', 'HASH') THEN 'ioc.threatfox.first_seen_indicators' WHEN s = 'MALWAREBAZAAR' AND entity_type = 'HASH' AND entity_key LIKE 'sha256:%' THEN 'malware.malwarebazaar.first_seen_hashes' END AS m FROM hb),
  ma AS (SELECT *, CASE WHEN s = 'THREATFOX' AND entity_type IN ('IP', 'DOMAIN', 'URL', 'HASH') THEN 'ioc.threatfox.first_seen_indicators' WHEN s = 'MALWAREBAZAAR' AND entity_type = 'HASH' AND entity_key LIKE 'sha256:%' THEN 'malware.malwarebazaar.first_seen_hashes' END AS m FROM ha)"""


@query(
    "novelty_changes",
    f"""WITH {NOVEL} SELECT mb.m AS measurement_key, entity_type, entity_key, 'ENTITY_FIRST_SOURCE_CHANGED' AS action, strftime(mb.t, {S}) AS event_time FROM ma JOIN mb USING (entity_type, entity_key) WHERE mb.m IS NOT NULL AND mb.m IS DISTINCT FROM ma.m
    UNION ALL SELECT ma.m, entity_type, entity_key, CASE WHEN mb.m IS NULL OR mb.m <> ma.m THEN 'NEW' ELSE 'REVISED' END, strftime(ma.t, {S}) FROM ma LEFT JOIN mb USING (entity_type, entity_key) WHERE ma.m IS NOT NULL AND (mb.m IS DISTINCT FROM ma.m OR mb.t IS DISTINCT FROM ma.t)""",
)
def novelty_changes(spark, d):
    """What late observations do to novelty facts: another first source takes its fact back and makes a new one."""
    e, u = events(spark, d), F.col("user_id") % 4
    source = F.when(F.col("event_type") == "click", "THREATFOX").when(F.col("event_type") == "view", "MALWAREBAZAAR").otherwise("OTHER")
    kind = F.when(u == 0, "IP").when(u == 3, "MALWARE").otherwise("HASH")
    key = F.when(u == 1, F.concat(F.lit("sha256:"), "user_id")).otherwise(F.col("user_id").cast("string"))
    obs = e.select(kind.alias("entity_type"), key.alias("entity_key"), source.alias("source_key"), F.col("event_id").alias("observation_key"), F.col("ts").alias("observed_time"), F.lit(None).cast("date").alias("observed_date"))
    history = lambda rows: E.entity_history(rows, ["entity_type", "entity_key"])
    out = E.novelty_changes(history(obs.where("observation_key % 2 = 0")), history(obs))
    return out.select("measurement_key", "entity_type", "entity_key", "action", stamp("event_time").alias("event_time"))


@query(
    "reconciled_findings",
    f"""WITH {FINDINGS}, e AS (SELECT entity_key, granularity, b, finding, CAST(observations AS VARCHAR) AS fp FROM fi), o AS (SELECT entity_key, granularity, b, finding, CAST(observations + CASE WHEN entity_key % 7 = 1 THEN 1 ELSE 0 END AS VARCHAR) AS fp FROM fi WHERE entity_key % 5 <> 0
      UNION ALL SELECT entity_key, 'WEEK', b, finding, 'x' FROM fi WHERE granularity = 'DAY' AND finding = 'CONCURRENT_MOVEMENT')
    SELECT entity_key, granularity, strftime(b, {S}) AS bucket, finding, CASE WHEN o.fp IS NULL THEN 'NEW' WHEN e.fp IS NULL THEN 'RETRACTED' ELSE 'REVISED' END AS action FROM e FULL JOIN o USING (entity_key, granularity, b, finding) WHERE e.fp IS DISTINCT FROM o.fp""",
)
def reconciled(spark, d):
    """Expected findings against active ones: what is new, revised or retracted."""
    e = E.convergence(E.entity_activity(contributing(spark, d)), 3600).select("entity_key", "granularity", "bucket_start", "finding", "observations")
    expected = e.withColumn("fp", F.col("observations").cast("string"))
    old = e.where("entity_key % 5 <> 0").withColumn("fp", (F.col("observations") + F.when(F.col("entity_key") % 7 == 1, 1).otherwise(0)).cast("string"))
    stray = e.where("granularity = 'DAY' and finding = 'CONCURRENT_MOVEMENT'").withColumns({"granularity": F.lit("WEEK"), "fp": F.lit("x")})
    out = reconcile(expected, old.unionByName(stray), ["entity_key", "granularity", "bucket_start", "finding"], "fp")
    return out.select("entity_key", "granularity", stamp("bucket_start").alias("bucket"), "finding", "action")


@query(
    "geo_map",
    """SELECT n_name AS country, count(DISTINCT c_custkey) AS entities, count(DISTINCT o_orderpriority) AS sources, count(DISTINCT o_orderstatus) AS origins FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def geo_map(spark, d):
    """Entities, sources and origins by country."""
    geo = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("country"))
    obs = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("source_key"), F.col("o_orderstatus").alias("origin"))
    asserted = E.geo_assert(obs, geo, "c_custkey").withColumn("entity_key", F.col("c_custkey"))
    return E.geo_map(asserted)


@query(
    "lineage_nodes",
    f"""WITH {FINDINGS}, w AS (SELECT DISTINCT entity_key FROM obs),
    o AS (SELECT entity_key, 1 AS depth, 'OBSERVATION' AS t, CAST(observation_key AS VARCHAR) AS k, t0 AS x, row_number() OVER (PARTITION BY entity_key ORDER BY t0 DESC, CAST(observation_key AS VARCHAR)) AS r FROM obs SEMI JOIN w USING (entity_key)),
    u AS (SELECT entity_key, 2 AS depth, 'BUCKET' AS t, granularity || '|' || strftime(b, {S}) AS k, b AS x FROM act SEMI JOIN w USING (entity_key)), u2 AS (SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY x DESC, k) AS r FROM u),
    f AS (SELECT entity_key, 3 AS depth, 'FINDING' AS t, finding || '|' || granularity || '|' || strftime(b, {S}) AS k, b AS x FROM fi SEMI JOIN w USING (entity_key)), f2 AS (SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY x DESC, k) AS r FROM f)
    SELECT entity_key, depth, t AS node_type, k AS node_key FROM o WHERE r <= 50 UNION ALL SELECT entity_key, depth, t, k FROM u2 WHERE r <= 10 UNION ALL SELECT entity_key, depth, t, k FROM f2 WHERE r <= 20 UNION ALL SELECT entity_key, 0, 'ENTITY', CAST(entity_key AS VARCHAR) FROM w""",
)
def lineage(spark, d):
    """Lineage of every entity, each hop with the limits of the feature."""
    obs, act = observations(spark, d), E.entity_activity(contributing(spark, d))
    want = obs.select("entity_key").distinct()
    return E.lineage(want, obs, act, E.convergence(act, 3600)).select("entity_key", "depth", "node_type", "node_key")


@query(
    "lineage_nodes_all",
    f"""WITH {FINDINGS}, w AS (SELECT DISTINCT entity_key FROM obs)
    SELECT entity_key, 1 AS depth, 'OBSERVATION' AS node_type, CAST(observation_key AS VARCHAR) AS node_key FROM obs UNION ALL SELECT entity_key, 2, 'BUCKET', granularity || '|' || strftime(b, {S}) FROM act
      UNION ALL SELECT entity_key, 3, 'FINDING', finding || '|' || granularity || '|' || strftime(b, {S}) FROM fi UNION ALL SELECT entity_key, 0, 'ENTITY', CAST(entity_key AS VARCHAR) FROM w""",
)
def lineage_whole(spark, d):
    """The whole lineage of every entity, every node of it, without the limits of the feature."""
    obs, act = observations(spark, d), E.entity_activity(contributing(spark, d))
    want = obs.select("entity_key").distinct()
    return E.lineage_nodes(want, obs, act, E.convergence(act, 3600)).select("entity_key", "depth", "node_type", "node_key")


GRAPH = f"""{FINDINGS}, w AS (SELECT DISTINCT entity_key FROM obs),
    o AS (SELECT entity_key, observation_key AS k, source_key, row_number() OVER (PARTITION BY entity_key ORDER BY t0 DESC, observation_key) AS r FROM obs QUALIFY r <= 50),
    u AS (SELECT entity_key, granularity || '|' || strftime(b, {S}) AS k, row_number() OVER (PARTITION BY entity_key ORDER BY b DESC, granularity || '|' || strftime(b, {S})) AS r FROM act QUALIFY r <= 10),
    f AS (SELECT entity_key, finding || '|' || granularity || '|' || strftime(b, {S}) AS k, granularity || '|' || strftime(b, {S}) AS bk, row_number() OVER (PARTITION BY entity_key ORDER BY b DESC, finding || '|' || granularity || '|' || strftime(b, {S})) AS r FROM fi QUALIFY r <= 20),
    n AS (SELECT entity_key, 0 AS p, 1 AS r, 0 AS s, 'entity:' || entity_key AS id, 'ENTITY' AS t FROM w UNION ALL SELECT entity_key, 0, 1, 1, 'history:h' || entity_key, 'ENTITY_HISTORY_REVISION' FROM w
      UNION ALL SELECT entity_key, 1, r, 0, 'observation:' || k, 'ENTITY_OBSERVATION_REVISION' FROM o UNION ALL SELECT entity_key, 1, r, 1, 'canonical:' || k, 'CANONICAL_RECORD' FROM o
      UNION ALL SELECT entity_key, 1, r, 2, 'raw:' || CAST(floor(k / 4) AS BIGINT), 'RAW_SOURCE_RECORD' FROM o UNION ALL SELECT entity_key, 1, r, 3, 'source:' || source_key, 'SOURCE_DEFINITION' FROM o
      UNION ALL SELECT entity_key, 2, r, 0, 'activity:' || k, 'ACTIVITY_BUCKET_REVISION' FROM u UNION ALL SELECT entity_key, 3, r, 0, 'finding:' || k, 'CONVERGENCE_FINDING_REVISION' FROM f),
    d AS (SELECT entity_key, id, min((p, r, s)) AS x, arg_min(t, (p, r, s)) AS t FROM n GROUP BY 1, 2), pn AS (SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY x) AS position FROM d QUALIFY position <= 100),
    e AS (SELECT entity_key, 0 AS p, 1 AS r, 0 AS s, 'entity:' || entity_key AS a, 'history:h' || entity_key AS b, 'CONTRIBUTES_TO_HISTORY' AS relation FROM w UNION ALL SELECT entity_key, 1, r, 0, 'observation:' || k, 'entity:' || entity_key, 'ASSERTS_ENTITY' FROM o
      UNION ALL SELECT entity_key, 1, r, 1, 'canonical:' || k, 'observation:' || k, 'ASSERTS_ENTITY' FROM o UNION ALL SELECT entity_key, 1, r, 2, 'raw:' || CAST(floor(k / 4) AS BIGINT), 'canonical:' || k, 'NORMALIZED_FROM' FROM o
      UNION ALL SELECT entity_key, 1, r, 3, 'raw:' || CAST(floor(k / 4) AS BIGINT), 'source:' || source_key, 'COLLECTED_FROM' FROM o UNION ALL SELECT entity_key, 2, r, 0, 'entity:' || entity_key, 'activity:' || k, 'CONTRIBUTES_TO_ACTIVITY' FROM u
      UNION ALL SELECT f.entity_key, 3, f.r, 0, 'activity:' || f.bk, 'finding:' || f.k, 'SUPPORTS_CONVERGENCE' FROM f JOIN pn ON pn.entity_key = f.entity_key AND pn.id = 'activity:' || f.bk),
    eb AS (SELECT e.*, s.id IS NOT NULL AND g.id IS NOT NULL AS both_in FROM e LEFT JOIN pn s ON s.entity_key = e.entity_key AND s.id = a LEFT JOIN pn g ON g.entity_key = e.entity_key AND g.id = b),
    pe AS (SELECT *, row_number() OVER (PARTITION BY entity_key, both_in ORDER BY p, r, s) AS position FROM eb)"""


def graph(spark, d):
    """The lineage graph of every entity: nodes and edges."""
    obs, act = observations(spark, d), E.entity_activity(contributing(spark, d))
    bucket = F.concat_ws("|", "granularity", stamp("bucket_start"))
    seen = obs.select("entity_key", F.col("observation_key").alias("observation_id"), F.col("observation_key").alias("canonical_id"), F.floor(F.col("observation_key") / 4).alias("raw_id"), "source_key", F.coalesce("observed_time", F.col("observed_date").cast("timestamp")).alias("at"))
    found = E.convergence(act, 3600).select("entity_key", F.concat_ws("|", "finding", bucket).alias("finding_id"), bucket.alias("bucket_id"), F.col("bucket_start").alias("at"))
    return E.lineage_graph(obs.select("entity_key").distinct().withColumn("history_id", F.concat(F.lit("h"), "entity_key")), seen, act.select("entity_key", bucket.alias("bucket_id"), F.col("bucket_start").alias("at")), found)


@query(
    "lineage_graph_nodes",
    f"""WITH {GRAPH}, c AS (SELECT entity_key, bool_or(NOT both_in OR position > 200) AS cut FROM pe GROUP BY 1), z AS (SELECT entity_key, count(*) AS every FROM pn GROUP BY 1)
    SELECT entity_key, id AS node_id, t AS node_type, position, every >= 100 OR coalesce(cut, false) AS truncated FROM pn JOIN z USING (entity_key) LEFT JOIN c USING (entity_key)""",
)
def graph_nodes(spark, d):
    """Nodes of the lineage graph."""
    return graph(spark, d)[0]


@query("lineage_graph_edges", f"WITH {GRAPH} SELECT entity_key, a AS source, b AS target, relation, position FROM pe WHERE both_in AND position <= 200")
def graph_edges(spark, d):
    """Edges of the lineage graph."""
    return graph(spark, d)[1]


@query(
    "geo_assertions",
    """SELECT n_name AS country, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 0 GROUP BY 1""",
)
def geo_assertions(spark, d):
    """Asserted countries; customers in debt stand for bogons."""
    geo = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("country"), (F.col("c_acctbal") < 0).alias("bogon"))
    return E.geo_assert(table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), geo, "c_custkey").groupBy("country").agg(F.count("*").alias("n"))


@query(
    "geo_pending",
    """SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate > DATE '1997-01-01')""",
)
def geo_pending(spark, d):
    """Customers without a fresh look-up of the policy; urgent orders stand for look-ups."""
    receipts = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("policy"), F.col("o_orderdate").cast("timestamp").alias("looked_up_at"))
    return E.geo_pending(table(spark, d, "customer").select("c_custkey"), receipts, "c_custkey", "1-URGENT", F.lit("1997-01-02").cast("timestamp"), 86400)


@query(
    "related_records",
    f"""WITH {EVENTS}, ix AS (SELECT event_id, ts, 'user' AS kind, CAST(user_id AS VARCHAR) AS key FROM ev UNION ALL SELECT event_id, ts, 'item', k FROM ev), r AS (SELECT *, row_number() OVER (PARTITION BY kind, key ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) AS r FROM ix  WHERE key IS NOT NULL)
    SELECT kind, key, CAST(event_id AS VARCHAR) AS source_record_id, strftime(ts, {S}) AS event_at FROM r WHERE r <= 25""",
)
def related(spark, d):
    """The newest 25 records (the page of the feature) that mention each entity there is."""
    rows = canonical(spark, d)
    asked = rows.select(F.explode("entities").alias("e")).select("e.kind", "e.key").where("key is not null").distinct()
    return E.related(rows, asked, 25).select("kind", "key", "source_record_id", stamp("event_at").alias("event_at"))


INDEX = f"""{EVENTS}, ix AS (SELECT event_id, ts, event_type, 'user' AS kind, CAST(user_id AS VARCHAR) AS key FROM ev UNION ALL SELECT event_id, ts, event_type, 'item', k FROM ev)"""
PLACED = "row_number() OVER (PARTITION BY kind, key ORDER BY epoch_us(ts) DESC, CAST(event_id AS VARCHAR) DESC) AS r"


def mentioned(rows):
    return rows.select(F.explode("entities").alias("e")).select("e.kind", "e.key").where("key is not null").distinct()


@query(
    "related_records_all",
    f"""WITH {INDEX}, r AS (SELECT *, {PLACED} FROM ix WHERE key IS NOT NULL) SELECT kind, key, CAST(event_id AS VARCHAR) AS source_record_id, CAST((r - 1) // 25 + 1 AS INTEGER) AS page, CAST((r - 1) % 25 + 1 AS INTEGER) AS position FROM r""",
)
def related_all(spark, d):
    """Every record that mentions an entity, with the page of 25 on which a reader of its list finds it."""
    rows = canonical(spark, d)
    out = numbered(E.related_rows(rows, mentioned(rows)), E.RELATED_KEY, E.RELATED_ORDER, 25)
    return out.select("kind", "key", "source_record_id", "page", "position")


@query(
    "related_records_walk",
    f"""WITH {INDEX}, r AS (SELECT *, {PLACED} FROM ix WHERE key IS NOT NULL) SELECT kind, key, CAST(event_id AS VARCHAR) AS source_record_id, CAST((r - 1) // 4 + 1 AS INTEGER) AS page, CAST((r - 1) % 4 + 1 AS INTEGER) AS position FROM r WHERE r <= 12""",
)
def related_walk(spark, d):
    """Three pages of four records for every entity, each page sought from the cursor of the one before it."""
    rows = canonical(spark, d)
    return E.related_walk(rows, mentioned(rows), 4, 3).select("kind", "key", "source_record_id", "page", "position")


@query(
    "related_records_filtered",
    f"""WITH {INDEX}, r AS (SELECT *, {PLACED} FROM ix WHERE key IS NOT NULL AND event_type = 'click' AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20') SELECT kind, key, CAST(event_id AS VARCHAR) AS source_record_id, strftime(ts, {S}) AS event_at FROM r WHERE r > 3 AND r <= 13""",
)
def related_filtered(spark, d):
    """The page of ten behind the first three records: one source, a half-open range, and a cursor for each entity."""
    rows = canonical(spark, d)
    some = {"source_key": "click", "start": "2024-01-10", "end": "2024-01-20"}
    first = E.related(rows, mentioned(rows), 3, **some)
    out = E.related(rows, mentioned(rows), 10, **some, cursors=cursors_of(first, E.RELATED_KEY))
    return out.select("kind", "key", "source_record_id", stamp("event_at").alias("event_at"))


RANGE = ("2024-01-05 00:00:00", "2024-01-25 00:00:00")


def finding_tables(spark, d):
    """Convergence findings, first sights and expansions with their ids, and the members of activity buckets."""
    own = contributing(spark, d)
    at = stamp("bucket_start")
    found = E.convergence(E.entity_activity(own), 3600).withColumns({"finding_id": F.concat_ws("|", "entity_key", "granularity", at, "finding"), "entity_type": (F.col("entity_key") % 3).cast("string")})
    seen = E.entity_history(observations(spark, d)).withColumn("first_basis", F.when(F.col("entity_key") % 4 == 0, "INITIAL_BOOTSTRAP").otherwise("LIVE_INCREMENTAL"))
    first = E.novelty(seen).withColumns({"finding_id": F.col("entity_key").cast("string"), "entity_type": (F.col("entity_key") % 3).cast("string")})
    grown = E.composition(E.activity_members(own), "HOUR").withColumns({"finding_id": F.concat_ws("|", "entity_key", at), "entity_type": (F.col("entity_key") % 3).cast("string")})
    return found, first, grown, E.activity_members(own)


LISTS = f"""{FINDINGS}, cl AS (SELECT entity_key || '|' || granularity || '|' || strftime(b, {S}) || '|' || finding AS id, b AS t FROM fi WHERE b >= TIMESTAMP '{RANGE[0]}' AND b < TIMESTAMP '{RANGE[1]}' AND o >= 2 AND entity_key % 3 = 1 AND (entity_key, granularity, b) IN (SELECT (entity_key, granularity, b) FROM ac WHERE source_class = 'IDENTITY')),
  nl AS (SELECT CAST(entity_key AS VARCHAR) AS id, min(t0) AS t FROM obs WHERE entity_key % 4 <> 0 GROUP BY entity_key HAVING min(t0) >= TIMESTAMP '2024-01-01'),
  hs AS (SELECT entity_key, b, list_distinct(list(source_key)) AS s, list_distinct(list(origin)) AS o, list_distinct(list(source_class)) AS c FROM ac WHERE granularity = 'HOUR' GROUP BY 1, 2),
  gr AS (SELECT h.entity_key, h.b, len(list_filter(h.s, lambda x: NOT list_contains(coalesce(p.s, []), x))) AS ns, len(list_filter(h.o, lambda x: NOT list_contains(coalesce(p.o, []), x))) AS no, len(list_filter(h.c, lambda x: NOT list_contains(coalesce(p.c, []), x))) AS nc FROM hs h LEFT JOIN hs p ON p.entity_key = h.entity_key AND p.b = h.b - INTERVAL 1 HOUR),
  gl AS (SELECT entity_key || '|' || strftime(b, {S}) AS id, b AS t, entity_key, ns, no, nc FROM gr WHERE ns + no + nc > 0 AND b >= TIMESTAMP '{RANGE[0]}' AND b < TIMESTAMP '{RANGE[1]}')"""


@query(
    "finding_list_pages",
    f"""WITH {LISTS}, p AS (SELECT 'convergence' AS list, id, row_number() OVER (ORDER BY t DESC, id DESC) AS r FROM cl UNION ALL SELECT 'new', id, row_number() OVER (ORDER BY t DESC, id DESC) FROM nl UNION ALL SELECT 'composition', id, row_number() OVER (ORDER BY t DESC, id DESC) FROM gl
      UNION ALL SELECT 'movers', id, row_number() OVER (ORDER BY no DESC, nc DESC, ns DESC, t DESC, id DESC) FROM gl) SELECT list, id AS finding_id, CAST((r - 1) // 20 + 1 AS INTEGER) AS page, CAST((r - 1) % 20 + 1 AS INTEGER) AS position FROM p WHERE r <= 40""",
)
def finding_list_pages(spark, d):
    """Two pages of the four lists of findings with their filters; the second is sought from the first one's cursor."""
    found, first, grown, members = finding_tables(spark, d)
    lists = {
        "convergence": lambda c: E.convergence_list(found, members, *RANGE, 20, c, entity_type="1", minimum_origins=2, source_class="IDENTITY"),
        "new": lambda c: E.novelty_list(first, "2024-01-01 00:00:00", "2024-02-01 00:00:00", 20, c),
        "composition": lambda c: E.composition_list(grown, *RANGE, 20, c),
        "movers": lambda c: E.composition_list(grown, *RANGE, 20, c, movers=True),
    }
    parts = []
    for name, ask in lists.items():
        one = ask(None)
        parts += [df.select(F.lit(name).alias("list"), "finding_id", F.lit(i).alias("page"), "position") for i, df in ((1, one), (2, ask(cursors_of(one, ()))))]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@query(
    "discovery_answer",
    f"""WITH {LISTS}, k AS (SELECT finding, count(*) AS n FROM fi WHERE b >= TIMESTAMP '{RANGE[0]}' AND b < TIMESTAMP '{RANGE[1]}' GROUP BY 1), m AS (SELECT *, row_number() OVER (ORDER BY no DESC, nc DESC, ns DESC, t DESC, id DESC) AS r FROM gl QUALIFY r <= 10)
    SELECT (SELECT string_agg(finding || '=' || n, ',' ORDER BY finding) FROM k) AS convergence, (SELECT count(*) FROM nl WHERE t >= TIMESTAMP '{RANGE[0]}' AND t < TIMESTAMP '{RANGE[1]}') AS new_entities, (SELECT count(*) FROM gl) AS expansions, (SELECT string_agg(entity_key || ':' || no || ':' || nc || ':' || ns, ',' ORDER BY r) FROM m) AS movers""",
)
def discovery_answer(spark, d):
    """One answer of four parts for a range: findings by type, new entities, expansions, and the top movers."""
    found, first, grown, _ = finding_tables(spark, d)
    out = E.discovery_answer(found, first, grown, *RANGE)
    told = lambda c, *names: F.array_join(F.transform(c, lambda x: F.concat_ws("=" if len(names) == 2 else ":", *[x[n] for n in names])), ",").alias(c)
    return out.select(told("convergence", "finding", "n"), "new_entities", "expansions", told("movers", "entity_key", "n_origins", "n_classes", "n_sources"))


def canonical(spark, d):
    """Canonical records: the user is the first entity, the item the second."""
    e = events(spark, d)
    entity = lambda kind, key: F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"), key.cast("string").alias("label"))
    none = F.lit(None).cast("timestamp")
    return e.select(F.col("event_type").alias("source_key"), F.col("event_id").cast("string").alias("source_record_id"), F.array(entity("user", F.col("user_id")), entity("item", F.col("k"))).alias("entities"), none.alias("effective_at"), F.col("ts").alias("published_at"), none.alias("updated_at"), none.alias("received_at"))


@query(
    "projected_observations",
    f"""WITH {EVENTS} SELECT source_key, entity_type, role, precision_kind AS precision, count(*) AS n, count(DISTINCT key) AS entities, strftime(min(t), {S}) AS first_time FROM (
      SELECT event_type AS source_key, 'user' AS entity_type, 'PRIMARY' AS role, CASE WHEN event_type = 'signup' THEN 'DATE' ELSE 'INSTANT' END AS precision_kind, CAST(user_id AS VARCHAR) AS key, CASE WHEN event_type <> 'signup' THEN ts END AS t FROM ev
      UNION ALL SELECT event_type, 'item', 'RELATED', CASE WHEN event_type = 'signup' THEN 'DATE' ELSE 'INSTANT' END, k, CASE WHEN event_type <> 'signup' THEN ts END FROM ev) GROUP BY 1, 2, 3, 4""",
)
def projected(spark, d):
    """Entity observations of canonical records, one source of date precision."""
    out = E.project_observations(canonical(spark, d), ["signup"])
    return out.groupBy("source_key", "entity_type", "role", "precision").agg(F.count("*").alias("n"), F.count_distinct("entity_key").alias("entities"), stamp(F.min("observed_time")).alias("first_time"))


@query("capable_entities", f"WITH {OBSERVATIONS} SELECT source_key, count(*) AS n FROM obs WHERE source_key IN ('click', 'purchase') GROUP BY 1")
def capable(spark, d):
    """Capability gate: only some entity types carry the flag."""
    caps = sources(spark, d).select(F.col("source_key").alias("entity_type"), F.col("source_key").isin("click", "purchase").alias("novelty"))
    rows = observations(spark, d).withColumn("entity_type", F.col("source_key"))
    return E.capable(rows, caps, "novelty").groupBy("source_key").agg(F.count("*").alias("n"))


@query(
    "admitted_sources",
    """WITH f AS (SELECT DISTINCT event_type, user_id AS u FROM events), p AS (SELECT event_type || '/' || u AS source_key, u % 13 <> 0 AS known, ['ADMITTED', 'ACTIVE', 'SUSPENDED', 'CANDIDATE', NULL][u % 5 + 1] AS st, u % 7 <> 0 AS hash, event_type <> 'error' AS collect,
      ['ALLOWED', 'RESTRICTED', 'PROHIBITED', 'NOT_APPLICABLE'][u % 4 + 1] AS raw, u % 11 <> 0 AS canon, ['ALLOWED', 'UNKNOWN', 'RESTRICTED'][u % 3 + 1] AS kept, u % 6 = 0 AS internal, u % 2 = 1 AS checked, u % 3 = 1 AS overdue FROM f),
    b AS (SELECT source_key, CASE WHEN NOT known THEN ['NO_CURRENT_ADMISSION'] ELSE list_filter([CASE WHEN st IS NULL OR st NOT IN ('ADMITTED', 'ACTIVE') THEN 'STATUS_' || coalesce(st, 'UNKNOWN') END, CASE WHEN NOT hash THEN 'POLICY_HASH_INVALID' END, CASE WHEN NOT collect THEN 'COLLECTION_NOT_ALLOWED' END,
      CASE WHEN raw = 'PROHIBITED' THEN 'RAW_RETENTION_PROHIBITED' END, CASE WHEN NOT canon THEN 'CANONICAL_PROJECTION_NOT_ALLOWED' END, CASE WHEN kept = 'UNKNOWN' THEN 'CANONICAL_RETENTION_UNKNOWN' END, CASE WHEN NOT internal AND NOT checked THEN 'TERMS_NOT_CHECKED' END, CASE WHEN overdue THEN 'ADMISSION_REVIEW_OVERDUE' END], lambda x: x IS NOT NULL) END AS b FROM p)
    SELECT source_key, array_to_string(b, ',') AS blockers, len(b) = 0 AS admitted FROM b""",
)
def admitted(spark, d):
    """The current admission of each feed with all that blocks it; some have none, some no review date, some no terms."""
    u = F.col("user_id")
    one_of = lambda *x: F.get(F.array(*[F.lit(v) for v in x]), (u % len(x)).cast("int"))
    feeds = events(spark, d).select("event_type", "user_id").distinct().withColumn("source_key", F.concat_ws("/", "event_type", "user_id"))
    admissions = feeds.where(u % 13 != 0).select(
        "source_key",
        one_of("ADMITTED", "ACTIVE", "SUSPENDED", "CANDIDATE", None).alias("admission_status"),
        (u % 7 != 0).alias("hash_valid"),
        (F.col("event_type") != "error").alias("collection_allowed"),
        one_of("ALLOWED", "RESTRICTED", "PROHIBITED", "NOT_APPLICABLE").alias("raw_retention"),
        (u % 11 != 0).alias("canonical_projection_allowed"),
        one_of("ALLOWED", "UNKNOWN", "RESTRICTED").alias("canonical_retention"),
        F.when(u % 6 == 0, "INTERNAL_TEST").alias("license_class"),
        F.when(u % 2 == 1, F.lit("2024-01-01").cast("timestamp")).alias("terms_checked_at"),
        one_of(None, "2024-01-10", "2024-12-31").cast("timestamp").alias("review_due_at"),
    )
    out = E.admissible(feeds.select("source_key"), admissions, F.lit("2024-02-01").cast("timestamp"))
    return out.select("source_key", F.array_join("blockers", ",").alias("blockers"), "admitted")


@query(
    "entity_profiles",
    f"""WITH {OBSERVATIONS}, r AS (SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY t0 DESC, observation_key DESC) AS r FROM obs), h AS (SELECT entity_key, count(*) AS observations FROM obs GROUP BY 1)
    SELECT entity_key, observation_key, source_key, observations FROM r JOIN h USING (entity_key) WHERE r <= 50""",
)
def profiles(spark, d):
    """History head of every entity with its newest 50 observations (the page of the feature)."""
    obs = observations(spark, d).withColumn("at", F.coalesce("observed_time", F.col("observed_date").cast("timestamp")))
    newest = heads(obs, ["entity_key"], [F.desc("at"), F.desc("observation_key")], 50)
    return newest.join(E.entity_history(observations(spark, d)).select("entity_key", "observations"), "entity_key").select("entity_key", "observation_key", "source_key", "observations")


@query(
    "latest_findings_with_class",
    f"""WITH {FINDINGS}, m AS (SELECT DISTINCT entity_key, granularity, b FROM ac WHERE source_class = 'IDENTITY') SELECT entity_key, granularity, strftime(b, {S}) AS bucket, finding FROM fi SEMI JOIN m USING (entity_key, granularity, b) WHERE o >= 2 ORDER BY b DESC, entity_key DESC, granularity DESC, finding DESC LIMIT 100""",
)
def latest_findings(spark, d):
    """A page of 100 findings of at least two origins that an IDENTITY source belongs to, newest first."""
    own = contributing(spark, d)
    found = E.convergence(E.entity_activity(own), 3600).where("origins >= 2")
    members = E.activity_members(own).where("source_class = 'IDENTITY'").select("entity_key", "granularity", "bucket_start").distinct()
    rows = found.join(members, ["entity_key", "granularity", "bucket_start"], "left_semi")
    return latest(rows, [F.desc("bucket_start"), F.desc("entity_key"), F.desc("granularity"), F.desc("finding")], 100).select("entity_key", "granularity", stamp("bucket_start").alias("bucket"), "finding")
