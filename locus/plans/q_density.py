"""Queries for the eps-range join and DBSCAN on PTD and PT (eps 1200, minPts 5).

The oracle is brute force: an all-pairs distance filter, then the
transitive closure of core-core edges as a recursive CTE, then the closed
form of SURVEY 2.6 for seeds, border points and noise in both modes.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from locus.operators import dbscan as db
from locus.plans import sqlparts as S
from locus.plans import fixtures as fx
from locus.plans.q_partitional import _pt
from locus.runtime import materialize

EPS = 1200.0
MIN_PTS = 5


def _ptd(spark, sf_dir):
    return materialize(fx.distinct_part_points(spark, sf_dir), "ptd")


def _parts(spark, sf_dir):
    return db.dbscan_parts(_ptd(spark, sf_dir), EPS, MIN_PTS)


def eps_neighbors(spark, sf_dir):
    return db.eps_neighbors(_ptd(spark, sf_dir), EPS)


def neighbor_counts(spark, sf_dir):
    """The neighbours of every point, itself included, from the compressed relation."""
    return db.neighbor_counts(_ptd(spark, sf_dir), EPS)


def eps_relation_expanded(spark, sf_dir):
    """The compressed relation, expanded."""
    return db.eps_relation(_ptd(spark, sf_dir), EPS).expand()


def dbscan_core_points(spark, sf_dir):
    """The core points.  Only the test count >= minPts is exact: points
    of dense cells are core without counting their cross-cell neighbours."""
    return _parts(spark, sf_dir).counts.filter("core").select("point_id")


def dbscan_core_components(spark, sf_dir):
    return _parts(spark, sf_dir).core.select("point_id", "seed")


def dbscan_clusters(spark, sf_dir):
    p = _parts(spark, sf_dir)
    return (db.labels(p, "order").withColumn("mode", F.lit("order"))
            .unionByName(db.labels(p, "canonical").withColumn("mode", F.lit("canonical"))))


def dbscan_all_rows(spark, sf_dir):
    """D7 on PT: every row's label, rows at one place alike."""
    pt = _pt(spark, sf_dir)
    return db.labels_of_rows(pt, db.dbscan_parts(pt, EPS, MIN_PTS))


def dbscan_noise(spark, sf_dir):
    p = _parts(spark, sf_dir)
    return (db.noise(p, "order").withColumn("mode", F.lit("order"))
            .unionByName(db.noise(p, "canonical").withColumn("mode", F.lit("canonical"))))


def dbscan_summary(spark, sf_dir):
    """D8 + A9: point, core, border, noise and cluster counts per mode."""
    p = _parts(spark, sf_dir)
    n_points = p.counts.count()
    out = None
    for mode in db.MODES:
        lab = db.labels(p, mode)
        row = lab.agg(
            F.lit(mode).alias("mode"),
            F.lit(n_points).cast("bigint").alias("n_points"),
            F.count(F.when(F.col("role") == "core", 1)).alias("n_core"),
            F.count(F.when(F.col("role") == "border", 1)).alias("n_border"),
            (F.lit(n_points) - F.count("*")).cast("bigint").alias("n_noise"),
            F.countDistinct("cluster_id").alias("n_clusters"))
        out = row if out is None else out.unionByName(row)
    return out


QUERIES = {
    "eps_neighbors": eps_neighbors,
    "neighbor_counts": neighbor_counts,
    "eps_relation_expanded": eps_relation_expanded,
    "dbscan_core_points": dbscan_core_points,
    "dbscan_core_components": dbscan_core_components,
    "dbscan_clusters": dbscan_clusters,
    "dbscan_all_rows": dbscan_all_rows,
    "dbscan_noise": dbscan_noise,
    "dbscan_summary": dbscan_summary,
}

_BASE = S.with_recursive(
    S.PTD,
    f"""nb AS (SELECT a.point_id AS p, b.point_id AS q FROM pt a, pt b
  WHERE sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= {EPS})""",
    "cnt AS (SELECT p, count(*) AS n FROM nb GROUP BY p)",
    f"core AS (SELECT p, n FROM cnt WHERE n >= {MIN_PTS})",
    "ce AS (SELECT nb.p AS a, nb.q AS b FROM nb JOIN core c1 ON nb.p = c1.p JOIN core c2 ON nb.q = c2.p)",
    "r(a, b) AS (SELECT p, p FROM core UNION SELECT r.a, ce.b FROM r JOIN ce ON r.b = ce.a)",
    "seed AS (SELECT a AS p, min(b) AS seed FROM r GROUP BY a)",
    """cl AS (SELECT seed, CAST(row_number() OVER (ORDER BY seed) AS INTEGER) AS cluster_id
  FROM (SELECT DISTINCT seed FROM seed) d)""",
    """bd AS (SELECT nb.p, min(s.seed) AS seed FROM nb JOIN seed s ON nb.q = s.p
  WHERE nb.p NOT IN (SELECT p FROM core) GROUP BY nb.p)""",
    """lab AS (
  SELECT m.mode, s.p AS point_id, cl.cluster_id, 'core' AS role
  FROM seed s JOIN cl USING (seed), (VALUES ('order'), ('canonical')) m(mode)
  UNION ALL
  SELECT m.mode, b.p, cl.cluster_id, 'border'
  FROM bd b JOIN cl USING (seed), (VALUES ('order'), ('canonical')) m(mode)
  WHERE m.mode = 'canonical' OR b.seed < b.p)""",
    """noi AS (SELECT m.mode, p.point_id FROM pt p, (VALUES ('order'), ('canonical')) m(mode)
  WHERE NOT EXISTS (SELECT 1 FROM lab l WHERE l.mode = m.mode AND l.point_id = p.point_id))""",
)

ORACLE = {
    "eps_neighbors": _BASE + "SELECT p AS point_id, q AS nbr_id FROM nb",
    "neighbor_counts": _BASE + "SELECT p AS point_id, n AS n_neighbors FROM cnt",
    "eps_relation_expanded": _BASE + "SELECT p AS point_id, q AS nbr_id FROM nb",
    "dbscan_core_points": _BASE + "SELECT p AS point_id FROM core",
    "dbscan_core_components": _BASE + "SELECT p AS point_id, seed FROM seed",
    "dbscan_clusters": _BASE + "SELECT mode, point_id, cluster_id, role FROM lab",
    "dbscan_all_rows": _BASE.rstrip() + ", " + S.PT.replace("pt AS", "pa AS", 1) + """
SELECT a.point_id, l.cluster_id, coalesce(l.role, 'noise') AS role
FROM pa a JOIN pt p ON a.x = p.x AND a.y = p.y
LEFT JOIN lab l ON l.point_id = p.point_id AND l.mode = 'order'""",
    "dbscan_noise": _BASE + "SELECT mode, point_id FROM noi",
    "dbscan_summary": _BASE + """
SELECT m.mode, (SELECT count(*) FROM pt) AS n_points,
       (SELECT count(*) FROM lab l WHERE l.mode = m.mode AND role = 'core') AS n_core,
       (SELECT count(*) FROM lab l WHERE l.mode = m.mode AND role = 'border') AS n_border,
       (SELECT count(*) FROM noi n WHERE n.mode = m.mode) AS n_noise,
       (SELECT count(DISTINCT cluster_id) FROM lab l WHERE l.mode = m.mode) AS n_clusters
FROM (VALUES ('order'), ('canonical')) m(mode)""",
}
