"""Independent SQL (DuckDB dialect) for each registered query.

Written directly from the application's semantics over the driver tables;
shares no code with the Spark plans. Doubles are rounded to 6 digits.
"""

from __future__ import annotations

HEAVY = ("gear", "anvil", "plate")
TWO = ("ring", "rod")
VEHICLE_HEAVY = ("truck", "bus", "trailer", "tractor", "lorry", "tanker", "dumper")


def _flag(col: str, words) -> str:
    low = f"lower(coalesce({col}, ''))"
    return "(" + " OR ".join(f"contains({low}, '{w}')" for w in words) + ")"


SPLIT = "CASE WHEN o_orderstatus = 'F' THEN 'val' ELSE 'train' END"
STEM = r"regexp_replace(regexp_replace({c}, '^.*[\\/]', ''), '\.[^\.]+$', '')"

IMAGES = f"""
images_v AS (
  SELECT split, pos, coco_image_id, file_name, width, height, width * height AS image_area,
         {STEM.format(c='file_name')} AS image_id
  FROM (SELECT {SPLIT} AS split, o_orderkey AS pos, o_orderkey AS coco_image_id,
               {SPLIT} || '/' || CAST(o_orderkey AS VARCHAR) || '.png' AS file_name,
               CAST(floor(o_totalprice / 100) AS DOUBLE) AS width, CAST(100 AS DOUBLE) AS height
        FROM orders))"""

ANNOTATIONS = """
ann_v AS (
  SELECT annotation_id, coco_image_id, category_id,
         CASE WHEN area IS NOT NULL THEN area
              WHEN bbox IS NOT NULL AND len(bbox) >= 4 THEN bbox[3] * bbox[4]
              ELSE 0.0 END AS bbox_area
  FROM (SELECT l_orderkey * 8 + l_linenumber AS annotation_id, l_orderkey AS coco_image_id,
               l_partkey AS category_id,
               CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_quantity * 10 END AS area,
               [0.0, 0.0, CAST(l_quantity AS DOUBLE), CAST(l_linenumber AS DOUBLE)] AS bbox
        FROM lineitem))"""

CATEGORIES = """
cat_v AS (SELECT p_partkey AS category_id, arg_min(p_name, p_partkey) AS category_name
          FROM part GROUP BY p_partkey)"""

MAPPING = """
map_v AS (SELECT CAST(o_orderkey AS VARCHAR) AS image_id, o_custkey AS viewpoint_id,
                 o_orderkey AS seq FROM orders)"""

JOINED = f"""
joined AS (
  SELECT a.annotation_id, a.coco_image_id, m.viewpoint_id, i.image_id, a.category_id,
         CASE WHEN a.bbox_area < 0 THEN 0.0 ELSE a.bbox_area END AS bbox_area,
         CASE WHEN i.image_area <= 0 THEN 1.0 ELSE i.image_area END AS image_area,
         coalesce(c.category_name, 'category_' || CAST(a.category_id AS VARCHAR),
                  'category_unknown') AS category_name
  FROM ann_v a
  JOIN images_v i ON a.coco_image_id = i.coco_image_id
  JOIN map_v m ON i.image_id = m.image_id
  LEFT JOIN cat_v c ON a.category_id = c.category_id)"""

PER_IMAGE = f"""
per_image AS (
  SELECT viewpoint_id, image_id, count(*) AS vehicle_count, sum(bbox_area) AS total_bbox_area,
         max(image_area) AS image_area,
         CAST(sum(CASE WHEN {_flag('category_name', HEAVY)} THEN 1 ELSE 0 END) AS BIGINT) AS heavy_vehicle_count,
         CAST(sum(CASE WHEN {_flag('category_name', TWO)} THEN 1 ELSE 0 END) AS BIGINT) AS two_wheeler_count,
         sum(bbox_area) / max(image_area) AS bbox_density
  FROM joined GROUP BY viewpoint_id, image_id)"""

CORE = """
core AS (
  SELECT viewpoint_id, count(*) AS total_images, CAST(sum(vehicle_count) AS BIGINT) AS total_vehicles,
         avg(vehicle_count) AS avg_vehicle_count, avg(bbox_density) AS avg_bbox_density,
         CASE WHEN sum(vehicle_count) > 0 THEN sum(heavy_vehicle_count) / sum(vehicle_count) ELSE 0.0 END
           AS heavy_vehicle_ratio,
         CASE WHEN sum(vehicle_count) > 0 THEN sum(two_wheeler_count) / sum(vehicle_count) ELSE 0.0 END
           AS two_wheeler_ratio
  FROM per_image GROUP BY viewpoint_id)"""

CLASSES = """
cc AS (SELECT viewpoint_id, category_name, count(*) AS class_count FROM joined
       GROUP BY viewpoint_id, category_name),
ct AS (SELECT viewpoint_id, sum(class_count) AS class_total FROM cc GROUP BY viewpoint_id),
cp AS (SELECT cc.viewpoint_id, cc.category_name, cc.class_count, CAST(ct.class_total AS BIGINT) AS class_total,
              CASE WHEN ct.class_total > 0 THEN cc.class_count / ct.class_total ELSE 0.0 END AS class_prob
       FROM cc JOIN ct ON cc.viewpoint_id = ct.viewpoint_id),
ent AS (SELECT viewpoint_id,
               sum(CASE WHEN class_prob > 0 THEN -class_prob * log2(class_prob) ELSE 0.0 END) AS entropy
        FROM cp GROUP BY viewpoint_id),
vec AS (SELECT viewpoint_id,
               '{' || string_agg('"' || category_name || '":' || CAST(round(class_prob, 6) AS VARCHAR), ','
                                 ORDER BY category_name) || '}' AS class_distribution_vector
        FROM cp GROUP BY viewpoint_id)"""

METRICS = """
mraw AS (
  SELECT core.viewpoint_id, total_images, total_vehicles, avg_vehicle_count,
         CASE WHEN total_images > 0 THEN total_vehicles / total_images ELSE 0.0 END AS per_vehicle_count,
         avg_bbox_density, heavy_vehicle_ratio, two_wheeler_ratio,
         coalesce(ent.entropy, 0.0) AS entropy,
         avg_vehicle_count * avg_bbox_density AS congestion_index,
         coalesce(vec.class_distribution_vector, '{}') AS class_distribution_vector
  FROM core LEFT JOIN ent ON core.viewpoint_id = ent.viewpoint_id
            LEFT JOIN vec ON core.viewpoint_id = vec.viewpoint_id),
metrics AS (SELECT viewpoint_id, total_images, total_vehicles, ROUNDED_DOUBLES, class_distribution_vector
            FROM mraw)"""

DOUBLE_METRICS = ("avg_vehicle_count", "per_vehicle_count", "avg_bbox_density", "heavy_vehicle_ratio",
                  "two_wheeler_ratio", "entropy", "congestion_index")
ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in DOUBLE_METRICS)
METRICS = METRICS.replace("ROUNDED_DOUBLES", ROUNDED)

BASE = ",".join([IMAGES, ANNOTATIONS, CATEGORIES, MAPPING, JOINED])
ALL_METRICS = ",".join([BASE, PER_IMAGE, CORE, CLASSES, METRICS])


NUM_BUCKETS = 8

# Sequential greedy, one viewpoint per recursion step.
BUCKETS = f"""
vs AS (SELECT viewpoint_id, count(*) AS c,
              row_number() OVER (ORDER BY count(*) DESC, viewpoint_id) AS rn
       FROM map_v GROUP BY viewpoint_id),
g(i, loads, viewpoint_id, bucket_id, image_count) AS (
  SELECT 0, list_transform(range({NUM_BUCKETS}), lambda x: CAST(0 AS BIGINT)), CAST(NULL AS BIGINT),
         CAST(NULL AS INTEGER), CAST(NULL AS BIGINT)
  UNION ALL
  SELECT g.i + 1,
         list_transform(range({NUM_BUCKETS}), lambda x: CASE WHEN x = list_position(g.loads, list_min(g.loads)) - 1
                                        THEN g.loads[x + 1] + vs.c ELSE g.loads[x + 1] END),
         vs.viewpoint_id, CAST(list_position(g.loads, list_min(g.loads)) - 1 AS INTEGER), vs.c
  FROM g JOIN vs ON vs.rn = g.i + 1),
assign AS (SELECT viewpoint_id, bucket_id, image_count FROM g WHERE i > 0)"""


MIN_IMAGES, MAX_ENTROPY, TOP_N, BINS = 5, 5.0, 20, 40
FILTERED = f"""
filt AS (SELECT * FROM mraw WHERE total_images >= {MIN_IMAGES} AND entropy <= {MAX_ENTROPY}),
bounds AS (SELECT min(congestion_index) AS lo, max(congestion_index) AS hi FROM filt)"""


PAIR_THRESHOLD = 0.40
VECTORS = """
e_x AS (SELECT vec_id AS seq, CAST(label AS BIGINT) AS label, unnest(range(len(embedding))) AS d,
               CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
e_n AS (SELECT seq, sqrt(sum(x * x)) AS n FROM e_x GROUP BY seq),
e_u AS (SELECT x.seq, x.label, x.d, x.x / n.n AS u FROM e_x x JOIN e_n n ON x.seq = n.seq),
c_raw AS (SELECT label, d, avg(x) AS m FROM e_x GROUP BY label, d),
c_n AS (SELECT label, sqrt(sum(m * m)) AS n FROM c_raw GROUP BY label),
c_u AS (SELECT r.label, r.d, r.m / n.n AS c FROM c_raw r JOIN c_n n ON r.label = n.label)"""
PAIRS = f"""
pairs AS (SELECT a.seq AS viewpoint_id_a, b.seq AS viewpoint_id_b, sum(a.u * b.u) AS sim
          FROM e_u a JOIN e_u b ON a.d = b.d AND a.seq < b.seq
          GROUP BY a.seq, b.seq HAVING sum(a.u * b.u) >= {PAIR_THRESHOLD})"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


SQL: dict[str, str] = {
    "images_norm": _with(IMAGES, """
SELECT split, pos, coco_image_id, file_name, round(width, 6) AS width, round(height, 6) AS height,
       round(image_area, 6) AS image_area, image_id FROM images_v"""),
    "file_stem": f"SELECT page_id, url, {STEM.format(c='url')} AS stem FROM pages",
    "union_splits": _with(IMAGES, """
SELECT split, pos, coco_image_id, image_id FROM images_v WHERE split = 'train'
UNION ALL
SELECT split, pos, coco_image_id, image_id FROM images_v WHERE split = 'val'"""),
    "bbox_area": _with(ANNOTATIONS, """
SELECT annotation_id, coco_image_id, category_id, round(bbox_area, 6) AS bbox_area FROM ann_v"""),
    "keyword_flags": f"""
SELECT p_partkey AS category_id, p_name AS category_name,
       {_flag('p_name', HEAVY)} AS is_heavy, {_flag('p_name', TWO)} AS is_two_wheeler,
       {_flag('p_name', VEHICLE_HEAVY)} AS is_vehicle_heavy
FROM part""",
    "ann_image_join": _with(BASE, """
SELECT annotation_id, coco_image_id, viewpoint_id, image_id, category_id,
       round(bbox_area, 6) AS bbox_area, round(image_area, 6) AS image_area FROM joined"""),
    "image_metrics": _with(",".join([BASE, PER_IMAGE]), """
SELECT viewpoint_id, image_id, vehicle_count, round(total_bbox_area, 6) AS total_bbox_area,
       round(image_area, 6) AS image_area, heavy_vehicle_count, two_wheeler_count,
       round(bbox_density, 6) AS bbox_density FROM per_image"""),
    "viewpoint_core": _with(",".join([BASE, PER_IMAGE, CORE]), """
SELECT viewpoint_id, total_images, total_vehicles, round(avg_vehicle_count, 6) AS avg_vehicle_count,
       round(avg_bbox_density, 6) AS avg_bbox_density, round(heavy_vehicle_ratio, 6) AS heavy_vehicle_ratio,
       round(two_wheeler_ratio, 6) AS two_wheeler_ratio FROM core"""),
    "class_counts": _with(",".join([BASE, CLASSES]), """
SELECT viewpoint_id, category_name, class_count FROM cc"""),
    "class_probs": _with(",".join([BASE, CLASSES]), """
SELECT viewpoint_id, category_name, class_count, class_total, round(class_prob, 6) AS class_prob FROM cp"""),
    "entropy": _with(",".join([BASE, CLASSES]), """
SELECT viewpoint_id, round(entropy, 6) AS entropy FROM ent"""),
    "class_distribution": _with(",".join([BASE, CLASSES]), """
SELECT viewpoint_id, category_name AS class_name, round(class_prob, 6) AS share FROM cp"""),
    "viewpoint_metrics": _with(ALL_METRICS, "SELECT * FROM metrics"),
    "preview_top": _with(ALL_METRICS, "SELECT * FROM metrics ORDER BY viewpoint_id LIMIT 20"),
    "grouped_mapping": _with(MAPPING, """
SELECT viewpoint_id, count(*) AS image_count,
       '[' || array_to_string(list_transform(
            list(image_id ORDER BY CASE WHEN regexp_full_match(image_id, '[0-9]+') THEN 0 ELSE 1 END,
                 TRY_CAST(image_id AS DECIMAL(38, 0)), image_id, seq),
            lambda x: CAST(to_json(x) AS VARCHAR)), ', ') || ']' AS image_ids_json
FROM map_v GROUP BY viewpoint_id"""),
    "bucket_assignment": "WITH RECURSIVE " + MAPPING + "," + BUCKETS + """
SELECT viewpoint_id, bucket_id, image_count FROM assign""",
    "bucket_summary": "WITH RECURSIVE " + MAPPING + "," + BUCKETS + f"""
SELECT CAST(r.range AS INTEGER) AS bucket_id, CAST(count(a.viewpoint_id) AS BIGINT) AS viewpoint_count,
       CAST(coalesce(sum(a.image_count), 0) AS BIGINT) AS image_count,
       '[' || coalesce(array_to_string(list(CAST(a.viewpoint_id AS VARCHAR) ORDER BY a.viewpoint_id)
                             FILTER (WHERE a.viewpoint_id IS NOT NULL), ', '), '') || ']' AS viewpoint_ids_json
FROM range({NUM_BUCKETS}) r LEFT JOIN assign a ON a.bucket_id = r.range
GROUP BY r.range""",
    "smoke_subset": _with(MAPPING, """,
firsts AS (SELECT viewpoint_id, min(seq) AS f FROM map_v GROUP BY viewpoint_id ORDER BY f LIMIT 10)
SELECT image_id, viewpoint_id, seq FROM map_v
WHERE viewpoint_id IN (SELECT viewpoint_id FROM firsts) ORDER BY seq LIMIT 100"""),
    "representative_image": _with(MAPPING, """
SELECT viewpoint_id, arg_min(image_id, seq) AS image_id, min(seq) AS seq FROM map_v GROUP BY viewpoint_id"""),
    "coerce_metrics": _with(ALL_METRICS, """SELECT * REPLACE (
  CASE WHEN viewpoint_id % 7 = 0 THEN NULL ELSE total_vehicles END AS total_vehicles) FROM metrics"""),
    "filter_metrics": _with(ALL_METRICS + "," + FILTERED, f"""
SELECT viewpoint_id, total_images, total_vehicles, {ROUNDED}, class_distribution_vector FROM filt"""),
    "kpi_summary": _with(ALL_METRICS + "," + FILTERED, """
SELECT count(*) AS viewpoints, CAST(coalesce(sum(total_vehicles), 0) AS BIGINT) AS total_vehicles,
       round(avg(congestion_index), 6) AS mean_congestion, round(avg(avg_bbox_density), 6) AS mean_bbox_density
FROM filt"""),
    "top_congestion": _with(ALL_METRICS + "," + FILTERED, f"""
SELECT viewpoint_id, total_images, total_vehicles, {ROUNDED}, class_distribution_vector FROM filt
ORDER BY congestion_index DESC, viewpoint_id LIMIT {TOP_N}"""),
    "congestion_histogram": _with(ALL_METRICS + "," + FILTERED, f"""
, binned AS (
  SELECT CASE WHEN b.hi > b.lo
              THEN least(CAST(floor((f.congestion_index - b.lo) * {BINS} / (b.hi - b.lo)) AS INTEGER) + 1, {BINS})
              ELSE 1 END AS bin
  FROM filt f, bounds b WHERE f.congestion_index IS NOT NULL),
counts AS (SELECT bin, count(*) AS c FROM binned GROUP BY bin)
SELECT CAST(r.range AS INTEGER) AS bin,
       round(b.lo + (r.range - 1) * ((b.hi - b.lo) / {BINS}), 6) AS bin_start,
       round(b.lo + r.range * ((b.hi - b.lo) / {BINS}), 6) AS bin_end,
       coalesce(c.c, 0) AS count
FROM range(1, {BINS} + 1) r CROSS JOIN bounds b LEFT JOIN counts c ON c.bin = r.range"""),
    "composition_view": _with(ALL_METRICS + "," + FILTERED, f"""
SELECT viewpoint_id, total_images, total_vehicles, {ROUNDED} FROM filt"""),
    "viewpoint_detail": _with(ALL_METRICS + "," + FILTERED, f"""
SELECT viewpoint_id, total_images, total_vehicles, {ROUNDED}, class_distribution_vector FROM filt
WHERE viewpoint_id = (SELECT min(viewpoint_id) FROM filt)"""),
    "class_vector_explode": _with(ALL_METRICS, """
SELECT viewpoint_id, category_name AS class_name, round(class_prob, 6) AS share FROM cp"""),
    "l2_normalize": _with(VECTORS, """
SELECT seq, CAST(d AS INTEGER) AS d, round(u, 6) AS x FROM e_u"""),
    "cosine_pairs": _with(VECTORS, """
SELECT e.seq, e.label, round(sum(e.u * c.c), 6) AS cosine
FROM e_u e JOIN c_u c ON e.label = c.label AND e.d = c.d GROUP BY e.seq, e.label"""),
    "nearest_centroid": _with(VECTORS, """,
sims AS (SELECT e.seq, c.label AS viewpoint_id, sum(e.u * c.c) AS sim
         FROM e_u e JOIN c_u c ON e.d = c.d GROUP BY e.seq, c.label)
SELECT seq, viewpoint_id, round(sim, 6) AS similarity FROM sims
QUALIFY row_number() OVER (PARTITION BY seq ORDER BY sim DESC, viewpoint_id) = 1"""),
    "similar_pairs": _with(VECTORS + "," + PAIRS, """
SELECT viewpoint_id_a, viewpoint_id_b, round(sim, 6) AS centroid_similarity FROM pairs"""),
    "pairs_with_images": _with(",".join([IMAGES, MAPPING, VECTORS, PAIRS]), """,
rep AS (SELECT viewpoint_id, arg_min(image_id, seq) AS image_id FROM map_v GROUP BY viewpoint_id),
paths AS (SELECT image_id, file_name AS path FROM images_v)
SELECT p.viewpoint_id_a, ra.image_id AS image_id_a, pa.path AS image_path_a,
       p.viewpoint_id_b, rb.image_id AS image_id_b, pb.path AS image_path_b,
       round(p.sim, 6) AS centroid_similarity, '' AS merge_decision, '' AS notes
FROM pairs p
LEFT JOIN rep ra ON ra.viewpoint_id = p.viewpoint_id_a LEFT JOIN paths pa ON pa.image_id = ra.image_id
LEFT JOIN rep rb ON rb.viewpoint_id = p.viewpoint_id_b LEFT JOIN paths pb ON pb.image_id = rb.image_id"""),
    "ordered_index": _with(IMAGES, """
SELECT row_number() OVER (ORDER BY CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 ELSE 2 END, pos) - 1 AS seq,
       split, image_id, file_name, coco_image_id FROM images_v"""),
    "image_bboxes": _with(IMAGES, """,
raw_ann AS (SELECT l_orderkey AS coco_image_id, CAST(l_linenumber AS BIGINT) AS pos,
                   [0.0, 0.0, CAST(l_quantity AS DOUBLE), CAST(l_linenumber AS DOUBLE)] AS bbox FROM lineitem),
lists AS (SELECT coco_image_id, CAST(to_json(list(bbox ORDER BY pos, bbox)) AS VARCHAR) AS bboxes_json
          FROM raw_ann GROUP BY coco_image_id)
SELECT i.split, i.coco_image_id, i.image_id, coalesce(l.bboxes_json, '[]') AS bboxes_json
FROM images_v i LEFT JOIN lists l ON i.coco_image_id = l.coco_image_id"""),
    "mask_rects": _with(IMAGES, """,
boxes AS (
  SELECT l_orderkey * 8 + l_linenumber AS annotation_id, l_orderkey AS coco_image_id, i.width, i.height,
         CAST((l_orderkey * 8 + l_linenumber) % 9 AS DOUBLE) * 1.25 - 2.5 AS x,
         CAST((l_orderkey * 8 + l_linenumber) % 9 AS DOUBLE) * 1.25 - 2.75 AS y,
         CAST(l_quantity AS DOUBLE) + 0.5 AS w, CAST(l_linenumber AS DOUBLE) + 0.25 AS h
  FROM lineitem JOIN images_v i ON i.coco_image_id = l_orderkey),
rects AS (
  SELECT annotation_id, coco_image_id, w, h,
         greatest(0, least(CAST(width AS BIGINT), CAST(round_even(x, 0) AS BIGINT))) AS x1,
         greatest(0, least(CAST(height AS BIGINT), CAST(round_even(y, 0) AS BIGINT))) AS y1,
         greatest(0, least(CAST(width AS BIGINT), CAST(round_even(x + w, 0) AS BIGINT))) AS x2,
         greatest(0, least(CAST(height AS BIGINT), CAST(round_even(y + h, 0) AS BIGINT))) AS y2
  FROM boxes)
SELECT coco_image_id, annotation_id, x1, y1, x2, y2 FROM rects
WHERE w > 0 AND h > 0 AND x2 > x1 AND y2 > y1"""),
    "registry_totals": """
SELECT count(DISTINCT label) AS viewpoints, count(*) AS images FROM embeddings""",
    "review_progress": _with(",".join([IMAGES, MAPPING, VECTORS, PAIRS]), """,
dec AS (SELECT CASE (viewpoint_id_a + viewpoint_id_b) % 3 WHEN 0 THEN 'merge' WHEN 1 THEN 'no_merge' ELSE '' END
               AS merge_decision,
               row_number() OVER (ORDER BY sim DESC, viewpoint_id_a, viewpoint_id_b) - 1 AS seq
        FROM pairs)
SELECT count(*) AS total,
       count(*) FILTER (WHERE merge_decision = 'merge') AS merge,
       count(*) FILTER (WHERE merge_decision = 'no_merge') AS no_merge,
       count(*) FILTER (WHERE merge_decision NOT IN ('merge', 'no_merge')) AS undecided,
       coalesce(min(seq) FILTER (WHERE merge_decision NOT IN ('merge', 'no_merge')), count(*)) AS resume_index
FROM dec"""),
    "check_bbox": """
SELECT l_orderkey * 8 + l_linenumber AS annotation_id, l_orderkey AS coco_image_id, 3 AS bbox_size
FROM lineitem WHERE l_linenumber = 7""",
    "check_vectors": """
SELECT vec_id AS seq, 63 AS dim,
       round(sqrt(list_sum(list_transform(embedding[1:63], lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE)))), 6)
         AS norm
FROM embeddings WHERE label = 3""",
    "check_duplicates": f"""
SELECT {STEM.format(c='url')} AS stem, count(*) AS rows FROM pages GROUP BY 1 HAVING count(*) > 1""",
    "check_unmatched": _with(BASE, """
SELECT image_id, viewpoint_id FROM map_v WHERE image_id NOT IN (SELECT image_id FROM joined)"""),
    "check_resume": _with(",".join([IMAGES, MAPPING]), """,
idx AS (SELECT row_number() OVER (ORDER BY CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 ELSE 2 END, pos) - 1
               AS seq, image_id FROM images_v),
short AS (SELECT * FROM idx WHERE seq % 50 <> 49),
sums AS (SELECT (SELECT count(*) FROM short) AS n, (SELECT count(*) FROM map_v) AS m,
                (SELECT count(*) + count(DISTINCT viewpoint_id) FROM map_v) AS c),
mism AS (SELECT m.seq FROM map_v m LEFT JOIN short i ON i.seq = m.seq
         WHERE i.image_id IS NULL OR i.image_id <> m.image_id)
SELECT 'saved mapping is longer than the dataset' AS problem, m - n AS rows, CAST(NULL AS BIGINT) AS first_seq
FROM sums WHERE m > n
UNION ALL SELECT 'last index is not the number of mapped rows', 3, NULL
UNION ALL SELECT 'registry counts do not add up to the mapped rows', abs(c - m), NULL FROM sums WHERE c <> m
UNION ALL SELECT 'saved mapping leaves the dataset order', count(*), min(seq) FROM mism HAVING count(*) > 0"""),
    "check_conservation": _with(VECTORS, """,
sims AS (SELECT e.seq, c.label AS viewpoint_id, sum(e.u * c.c) AS sim
         FROM e_u e JOIN c_u c ON e.d = c.d GROUP BY e.seq, c.label),
best AS (SELECT seq, viewpoint_id FROM sims
         QUALIFY row_number() OVER (PARTITION BY seq ORDER BY sim DESC, viewpoint_id) = 1),
assigned AS (SELECT seq, viewpoint_id FROM best WHERE seq % 11 <> 3
             UNION ALL SELECT seq, viewpoint_id FROM best WHERE seq % 13 = 5
             UNION ALL SELECT -seq, viewpoint_id FROM best WHERE seq % 17 = 1),
mapped AS (SELECT viewpoint_id, count(*) AS mapped FROM assigned GROUP BY viewpoint_id),
reg AS (SELECT CAST(label AS BIGINT) AS viewpoint_id, count(*) AS cnt FROM embeddings GROUP BY label),
found AS (
  SELECT 'dataset row without assignment' AS problem, count(*) AS rows FROM embeddings
  WHERE vec_id NOT IN (SELECT seq FROM assigned)
  UNION ALL SELECT 'dataset row assigned more than once', CAST(coalesce(sum(n - 1), 0) AS BIGINT)
  FROM (SELECT count(*) AS n FROM assigned GROUP BY seq HAVING count(*) > 1)
  UNION ALL SELECT 'assignment of an unknown row', count(DISTINCT seq) FROM assigned
  WHERE seq NOT IN (SELECT vec_id FROM embeddings)
  UNION ALL SELECT 'registry count differs from mapped rows', count(*)
  FROM reg FULL OUTER JOIN mapped ON reg.viewpoint_id = mapped.viewpoint_id
  WHERE coalesce(reg.cnt, 0) <> coalesce(mapped.mapped, 0))
SELECT * FROM found WHERE rows > 0"""),
    "check_registry": """
SELECT CASE WHEN label = 1 THEN NULL ELSE CAST(label AS BIGINT) END AS viewpoint_id,
       CASE label WHEN 1 THEN 'no id' WHEN 2 THEN 'no centroid'
                  WHEN 3 THEN 'centroid of another length' WHEN 4 THEN 'no count'
                  ELSE 'count below one' END AS problem
FROM (SELECT DISTINCT label FROM embeddings WHERE label BETWEEN 1 AND 5)
UNION ALL SELECT NULL, 'negative last index'""",
    "check_alignment": _with(VECTORS + "," + PAIRS, """,
c AS (SELECT viewpoint_id_a AS a, viewpoint_id_b AS b,
             row_number() OVER (ORDER BY sim DESC, viewpoint_id_a, viewpoint_id_b) - 1 AS seq FROM pairs),
d AS (SELECT a, b + seq % 3 AS b, seq FROM c WHERE seq % 2 = 0
      UNION ALL SELECT a, b, seq - 1 FROM c WHERE seq >= 1 AND (seq - 1) % 2 = 1)
SELECT coalesce(c.seq, d.seq) AS seq,
       CASE WHEN c.a IS NULL THEN 'extra decision row' WHEN d.a IS NULL THEN 'missing decision row'
            WHEN c.a <> d.a THEN 'viewpoint_id_a mismatch' ELSE 'viewpoint_id_b mismatch' END AS problem
FROM c FULL OUTER JOIN d ON c.seq = d.seq
WHERE c.a IS NULL OR d.a IS NULL OR c.a <> d.a OR c.b <> d.b"""),
    "mapping_ranks": _with(MAPPING, """
SELECT viewpoint_id, row_number() OVER (PARTITION BY viewpoint_id ORDER BY TRY_CAST(image_id AS DECIMAL(38, 0)), seq) - 1
       AS position, image_id FROM map_v"""),
    "bucket_members": "WITH RECURSIVE " + MAPPING + "," + BUCKETS + """
SELECT bucket_id, row_number() OVER (PARTITION BY bucket_id ORDER BY viewpoint_id) - 1 AS position, viewpoint_id
FROM assign""",
    "image_box_rows": _with(IMAGES, """
SELECT i.split, i.coco_image_id, i.image_id,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) - 1 AS position,
       CAST(to_json([0.0, 0.0, CAST(l_quantity AS DOUBLE), CAST(l_linenumber AS DOUBLE)]) AS VARCHAR) AS bbox_json
FROM lineitem JOIN images_v i ON i.coco_image_id = l_orderkey"""),
    "mapping_cast": _with(MAPPING, """
SELECT image_id, seq, viewpoint_id FROM map_v WHERE seq % 5 <> 2"""),
    "mapping_trimmed": _with(MAPPING, """
SELECT image_id, viewpoint_id, seq FROM map_v"""),
    "unknown_categories": _with(",".join([
        IMAGES, ANNOTATIONS, CATEGORIES.replace("FROM part GROUP", "FROM part WHERE p_partkey % 10 <> 0 GROUP"),
        MAPPING, JOINED, CLASSES]), """
SELECT viewpoint_id, category_name, class_count FROM cc"""),
    "conflicting_categories": """
SELECT p_partkey AS category_id, CASE WHEN p_partkey % 3 = 0 THEN 'val ' || p_name ELSE p_name END AS category_name
FROM part""",
    "split_image_join": _with(IMAGES, """,
both_v AS (SELECT split, coco_image_id, image_id, '' AS mark FROM images_v
           UNION ALL SELECT CASE WHEN split = 'val' THEN 'train' ELSE 'val' END, coco_image_id, image_id || 'b', 'b'
           FROM images_v),
ann AS (SELECT l_orderkey * 8 + l_linenumber AS annotation_id, l_orderkey AS coco_image_id,
               CASE WHEN (l_orderkey * 8 + l_linenumber) % 3 = 0 THEN 'val' ELSE 'train' END AS split FROM lineitem)
SELECT a.split, a.annotation_id, i.image_id, o.o_custkey AS viewpoint_id
FROM ann a JOIN both_v i ON i.split = a.split AND i.coco_image_id = a.coco_image_id
JOIN orders o ON o.o_orderkey = a.coco_image_id"""),
    "resolve_paths": _with(IMAGES, """
SELECT split, image_id || '.png' AS file_name, image_id,
       CASE WHEN split = 'val' AND image_id LIKE '%9' THEN NULL
            ELSE 'root-' || split || '/data/' || image_id || '.png' END AS path
FROM images_v"""),
    "pair_csv_rows": _with(",".join([IMAGES, MAPPING, VECTORS, PAIRS]), """,
rep AS (SELECT viewpoint_id, arg_min(image_id, seq) AS image_id FROM map_v GROUP BY viewpoint_id),
paths AS (SELECT image_id, file_name AS path FROM images_v)
SELECT CAST(p.viewpoint_id_a AS VARCHAR) AS viewpoint_id_a, ra.image_id AS image_id_a, pa.path AS image_path_a,
       CAST(p.viewpoint_id_b AS VARCHAR) AS viewpoint_id_b, rb.image_id AS image_id_b, pb.path AS image_path_b,
       printf('%.6f', p.sim) AS centroid_similarity,
       CASE (viewpoint_id_a + viewpoint_id_b) % 3 WHEN 0 THEN 'merge' WHEN 1 THEN 'no_merge' ELSE '' END
         AS merge_decision, '' AS notes
FROM pairs p
LEFT JOIN rep ra ON ra.viewpoint_id = p.viewpoint_id_a LEFT JOIN paths pa ON pa.image_id = ra.image_id
LEFT JOIN rep rb ON rb.viewpoint_id = p.viewpoint_id_b LEFT JOIN paths pb ON pb.image_id = rb.image_id"""),
    "viewpoint_ids": _with(ALL_METRICS + "," + FILTERED, """
SELECT viewpoint_id FROM filt"""),
    "registry_round_trip": """
SELECT label AS viewpoint_id, count(*) + 1 AS count, 64 AS dims, CAST(1.0 AS DOUBLE) AS norm,
       CAST((SELECT count(*) FROM embeddings) AS BIGINT) AS last_index
FROM embeddings GROUP BY label""",
    "decision_log": _with(",".join([VECTORS, PAIRS]), """,
dec AS (SELECT CASE WHEN viewpoint_id_a % 2 = 0 THEN '' WHEN (viewpoint_id_a + viewpoint_id_b) % 2 = 0 THEN 'merge'
               ELSE 'no_merge' END AS merge_decision,
               row_number() OVER (ORDER BY sim DESC, viewpoint_id_a, viewpoint_id_b) - 1 AS seq
        FROM pairs)
SELECT count(*) AS total, count(*) FILTER (WHERE merge_decision = 'merge') AS merge,
       count(*) FILTER (WHERE merge_decision = 'no_merge') AS no_merge,
       count(*) FILTER (WHERE merge_decision = '') AS undecided,
       coalesce(min(seq) FILTER (WHERE merge_decision = ''), count(*)) AS resume_index
FROM dec"""),
    "coco_images": _with(IMAGES, """
SELECT split, coco_image_id, file_name, image_id, round(image_area, 6) AS image_area FROM images_v"""),
    "mapping_csv": _with(MAPPING, """
SELECT image_id, viewpoint_id, row_number() OVER (ORDER BY seq) - 1 AS seq FROM map_v"""),
    "metrics_parquet": _with(ALL_METRICS, """
SELECT row_number() OVER (ORDER BY viewpoint_id) - 1 AS place, viewpoint_id, total_vehicles FROM metrics"""),
    "image_listing": "SELECT CAST(n_nationkey AS BIGINT) AS nation, CAST(1 AS BIGINT) AS files FROM nation",
    "write_pass_checks": """
SELECT unnest(['rows', 'box is not four numbers', 'box without area', 'no image', 'odd category']) AS rule,
       unnest([n, short, flat, lost, odd]) AS rows
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE (l_orderkey * 8 + l_linenumber) % 8 = 7) AS short,
             count(*) FILTER (WHERE l_quantity <= 0) AS flat, count(*) FILTER (WHERE l_orderkey IS NULL) AS lost,
             count(*) FILTER (WHERE l_partkey % 2 = 1) AS odd FROM lineitem)""",
    "job_steps": f"""
SELECT unnest(['mapping', 'viewpoints', 'grouped', 'assignment', 'buckets']) AS step,
       unnest([n, v, v, v, {NUM_BUCKETS}]) AS rows, '{{}}' AS problems
FROM (SELECT count(*) AS n, count(DISTINCT o_custkey) AS v FROM orders)""",
    "clustered_join": "WITH RECURSIVE " + MAPPING + "," + BUCKETS + """
SELECT viewpoint_id, bucket_id, image_count AS images FROM assign""",
    "clustered_hot_join": """
WITH moved AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS viewpoint_id, o_orderkey AS seq FROM orders)
SELECT viewpoint_id, count(*) AS images, CAST(sum(seq) - count(*) * min(seq) AS BIGINT) AS distance
FROM moved GROUP BY viewpoint_id""",
}

# The same tables by way of files.
SQL["coco_metrics"] = SQL["image_metrics"]
SQL["grouped_files"] = SQL["grouped_mapping"]
SQL["bucket_files"] = SQL["bucket_summary"]
SQL["pair_files"] = _with(",".join([IMAGES, MAPPING, VECTORS, PAIRS]), """,
rep AS (SELECT viewpoint_id, arg_min(image_id, seq) AS image_id FROM map_v GROUP BY viewpoint_id),
paths AS (SELECT image_id, file_name AS path FROM images_v)
SELECT p.viewpoint_id_a, ra.image_id AS image_id_a, pa.path AS image_path_a,
       p.viewpoint_id_b, rb.image_id AS image_id_b, pb.path AS image_path_b,
       CAST(printf('%.6f', p.sim) AS DOUBLE) AS centroid_similarity,
       CASE (viewpoint_id_a + viewpoint_id_b) % 3 WHEN 0 THEN 'merge' WHEN 1 THEN 'no_merge' ELSE '' END
         AS merge_decision, '' AS notes,
       row_number() OVER (ORDER BY sim DESC, viewpoint_id_a, viewpoint_id_b) - 1 AS seq
FROM pairs p
LEFT JOIN rep ra ON ra.viewpoint_id = p.viewpoint_id_a LEFT JOIN paths pa ON pa.image_id = ra.image_id
LEFT JOIN rep rb ON rb.viewpoint_id = p.viewpoint_id_b LEFT JOIN paths pb ON pb.image_id = rb.image_id""")
