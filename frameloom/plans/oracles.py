"""ANSI SQL of the core queries, for DuckDB over the same tables."""

from __future__ import annotations

_COLS = "scene_token, scene_name, timestamp, camera, cam_path, lidar_path, location, weather, time_of_day, ego_speed_mps, num_lidar_pts"
_S = f"s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_token ORDER BY ingested_at DESC NULLS LAST, {', '.join(c + ' NULLS FIRST' for c in _COLS.split(', '))}) AS nth FROM samples WHERE sample_token IS NOT NULL) WHERE nth = 1)"


def _u(name: str, column: str) -> str:
    sound = f"len({column}) = 64 AND len(list_filter({column}, lambda x: x IS NOT NULL AND isfinite(x))) = 64 AND len(list_filter({column}, lambda x: x <> 0)) > 0"
    return f"{name} AS MATERIALIZED (SELECT token, list_transform(w, lambda x: x / (sqrt(list_dot_product(w, w)) + 1e-8)) AS v FROM (SELECT sample_token AS token, min({column})::DOUBLE[] AS w FROM encoded_batch WHERE sample_token IS NOT NULL AND {sound} GROUP BY 1))"


_D, _C = _u("dino", "dinov2"), _u("clip", "clip_image")
_P = "p AS (SELECT prompt_id, prompt, list_transform(w, lambda x: x / (sqrt(list_dot_product(w, w)) + 1e-8)) AS v FROM (SELECT prompt_id, prompt, clip_text::DOUBLE[] AS w FROM failure_prompts))"
_M = "m AS MATERIALIZED (SELECT token AS sample_token, prompt_id AS cluster_id, sim FROM (SELECT token, prompt_id, list_dot_product(clip.v, p.v) AS sim, row_number() OVER (PARTITION BY token ORDER BY round(list_dot_product(clip.v, p.v), 10) DESC, prompt_id) AS r FROM clip, p) WHERE r = 1)"
_E = "e AS MATERIALIZED (SELECT a.token AS a, b.token AS b, list_dot_product(a.v, b.v) AS sim FROM dino a JOIN dino b ON a.token < b.token WHERE list_dot_product(a.v, b.v) >= 0.97)"
_CC = "cc(token, root) AS (SELECT a, a FROM e UNION SELECT b, b FROM e UNION SELECT x.t, cc.root FROM cc JOIN (SELECT a AS f, b AS t FROM e UNION ALL SELECT b, a FROM e) x ON x.f = cc.token)"
_R = "r AS MATERIALIZED (SELECT token, min(root) AS root FROM cc GROUP BY 1)"
_GROUPS = f"{_D}, {_E}, {_CC}, {_R}"
_DROP = "dropped AS (SELECT token AS sample_token FROM r WHERE token <> root)"
_K = "k AS MATERIALIZED (SELECT a.token AS sample_token, round(1 - round(list_dot_product(a.v, b.v), 10), 6) AS knn_distance FROM clip a JOIN clip b ON a.token <> b.token QUALIFY row_number() OVER (PARTITION BY a.token ORDER BY round(list_dot_product(a.v, b.v), 10) DESC, b.token) = 10)"
_O = "o AS MATERIALIZED (SELECT sample_token, knn_distance, (row_number() OVER (ORDER BY knn_distance DESC, sample_token) - 1)::INT AS rank FROM k QUALIFY rank < greatest(1, floor((SELECT count(*) FROM clip) * 0.05)))"
_T = """sizes AS (SELECT cluster_id, count(*) AS size, (row_number() OVER (ORDER BY count(*) DESC, cluster_id) - 1)::INT AS cluster_rank FROM m GROUP BY 1),
 taken AS MATERIALIZED (SELECT cluster_id, cluster_rank, sample_token, member_idx::INT AS member_idx FROM (SELECT cluster_id, sample_token, row_number() OVER (PARTITION BY cluster_id ORDER BY sample_token) AS member_idx FROM m WHERE sample_token NOT IN (SELECT sample_token FROM dropped)) JOIN sizes USING (cluster_id)
 WHERE member_idx <= greatest(1, round_even(120.0::DOUBLE * size / (SELECT count(*) FROM m), 0)::INT)),
 boosted AS MATERIALIZED (SELECT sample_token, rank FROM o WHERE sample_token NOT IN (SELECT sample_token FROM dropped) AND sample_token NOT IN (SELECT sample_token FROM taken))"""
_ALL = f"{_GROUPS}, {_DROP}, {_C}, {_P}, {_M}, {_K}, {_O}, {_T}"
_SEED = "('0x' || substr(md5({0}), 1, 8))::BIGINT"
_Q = f"q AS (SELECT * FROM clip WHERE {_SEED.format('token')} % 100 = 0)"
_SHA = "sha256(coalesce(list_aggregate(list_transform(list_sort(coalesce(kept, [])), lambda t: t || chr(10)), 'string_agg', ''), ''))"
_JOIN = "list_aggregate({0}, 'string_agg', ',')"
_TOPK = "SELECT query, token, rank, sim FROM (SELECT q.token AS query, c.token AS token, (row_number() OVER (PARTITION BY q.token ORDER BY round(list_dot_product(q.v, c.v), 10) DESC, c.token))::INT AS rank, round(list_dot_product(q.v, c.v), 6) AS sim FROM {0}) WHERE rank <= 10"
_CELLS = "cells AS (SELECT token, prompt_id FROM (SELECT token, prompt_id, row_number() OVER (PARTITION BY token ORDER BY list_dot_product(clip.v, p.v) DESC, prompt_id) AS r FROM clip, p) WHERE r <= {0})"
_IVF = f"own AS ({_CELLS.format(1)[10:-1]}), probes AS ({_CELLS.format(4)[10:-1]})"
_IVFK = _TOPK.format("q JOIN probes ON probes.token = q.token JOIN own ON own.prompt_id = probes.prompt_id JOIN clip c ON c.token = own.token")


def _u01(name: str) -> str:
    return f"(('0x' || substr(md5('7:{name}:' || idx), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


_PICK = "[{0}][(scene % {1}) + 1]"
_SUMMARY = f"""{_S}, g AS (SELECT * FROM duplicate_groups WHERE members IS NOT NULL),
 c AS (SELECT (SELECT count(*) FROM s) AS n, (SELECT count(DISTINCT scene_name) FROM s) AS sc, (SELECT count(*) FROM g) AS g, (SELECT coalesce(sum(len(members)), 0)::BIGINT FROM g) AS m,
  (SELECT count(DISTINCT t) FROM (SELECT unnest(boosted_outliers) AS t FROM curation_set)) AS o, (SELECT count(*) FROM clusters) AS cl, (SELECT count(DISTINCT t) FROM (SELECT unnest(kept) AS t FROM curation_set)) AS k)"""


def oracle_sql() -> dict[str, str]:
    return {
        "samples_scan": f"WITH {_S} SELECT sample_token, scene_name, timestamp::VARCHAR AS timestamp, location, weather, num_lidar_pts::VARCHAR AS num_lidar_pts FROM s",
        "samples_roundtrip": f"WITH {_S} SELECT sample_token, scene_name, timestamp::VARCHAR AS timestamp, weather, num_lidar_pts::VARCHAR AS num_lidar_pts FROM s",
        "synthetic_samples": f"""WITH a AS (SELECT range AS idx, range % 24 AS scene, range // 24 AS before FROM range(2000)),
          b AS (SELECT *, {_u01("dup")} < 0.12 AND idx > 5 AND before > 0 AS dup, (floor({_u01("sibling")} * before)::BIGINT + 1) * 24 AS back,
           'scene-' || lpad(scene::VARCHAR, 4, '0') || '-' || {_PICK.format("'urban_intersection','highway_merge','tunnel','construction_zone','residential','parking_lot'", 6)} AS scene_name FROM a),
          c AS (SELECT *, 'sample_' || lpad(idx::VARCHAR, 5, '0') || CASE WHEN dup THEN '_dup_' || right('sample_' || lpad((idx - back)::VARCHAR, 5, '0'), 6) ELSE '' END AS sample_token FROM b)
          SELECT sample_token, substr(md5(scene_name), 1, 16) AS scene_token, scene_name, 1700000000000000 + idx * 500000 AS timestamp, 'synthetic://' || sample_token || '/CAM_FRONT.jpg' AS cam_path,
           {_PICK.format("'boston-seaport','singapore-onenorth','singapore-queenstown','singapore-hollandvillage'", 4)} AS location, {_PICK.format("'clear','clear','clear','rain','rain','fog'", 6)} AS weather,
           {_PICK.format("'day','day','day','night','night','dusk'", 6)} AS time_of_day, round((({_u01("speed")} * 22.0)::FLOAT)::DOUBLE, 3) AS ego_speed, (20000 + floor({_u01("points")} * 100001))::INT AS num_lidar_pts FROM c""",
        "token_seed": f"SELECT DISTINCT sample_token, {_SEED.format('sample_token')} AS seed FROM samples WHERE sample_token IS NOT NULL",
        "keyframe_join": f"""WITH {_S}, w AS (SELECT * FROM s WHERE scene_token IS NOT NULL AND location IS NOT NULL),
          sc AS (SELECT scene_token, min(scene_name) AS scene_name, min(concat_ws(' ', weather, time_of_day)) AS de, min(location) AS lo FROM w GROUP BY 1)
          SELECT sample_token, w.scene_token, sc.scene_name, timestamp::VARCHAR AS timestamp, 'samples/CAM_FRONT/' || sample_token || '.jpg' AS cam_path, 'samples/LIDAR_TOP/' || sample_token || '.bin' AS lidar_path, upper(lo) AS location,
           CASE WHEN contains(lower(de), 'rain') THEN 'rain' WHEN contains(lower(de), 'fog') THEN 'fog' ELSE 'clear' END AS weather,
           CASE WHEN contains(lower(de), 'night') THEN 'night' WHEN contains(lower(de), 'dusk') OR contains(lower(de), 'dawn') THEN 'dusk' ELSE 'day' END AS time_of_day
          FROM w JOIN sc ON sc.scene_token = w.scene_token WHERE cam_path IS NOT NULL AND lidar_path IS NOT NULL""",
        "payload_projection": f"WITH {_S} SELECT sample_token, scene_name, weather, time_of_day FROM s",
        "sample_records": f"WITH {_S}, {_C} SELECT sample_token, scene_name, weather, time_of_day, location, round(ego_speed_mps::DOUBLE, 2) AS ego_speed_mps, round(v[1], 6) AS x, round(v[2], 6) AS y FROM s JOIN clip ON token = sample_token",
        "infer_conditions": """SELECT doc_id, CASE WHEN contains(lower(text), 'rain') THEN 'rain' WHEN contains(lower(text), 'fog') THEN 'fog' ELSE 'clear' END AS weather,
          CASE WHEN contains(lower(text), 'night') THEN 'night' WHEN contains(lower(text), 'dusk') OR contains(lower(text), 'dawn') THEN 'dusk' ELSE 'day' END AS time_of_day FROM documents""",
        "scene_fields": "SELECT scene_name, count(*) AS n, substr(md5(scene_name), 1, 16) AS scene_token, string_split(scene_name, '-')[-1] AS template, regexp_extract(scene_name, '^scene-(\\d+)', 1) AS number FROM samples WHERE scene_name IS NOT NULL GROUP BY scene_name",
        "prior_siblings": f"WITH {_S} SELECT sample_token, rank() OVER (PARTITION BY scene_name ORDER BY timestamp) - 1 AS n_prior FROM s WHERE scene_name IS NOT NULL AND timestamp IS NOT NULL",
        "vec_normalize": f"WITH {_D} SELECT token, (i - 1)::INT AS pos, round(v[i], 6) AS x FROM dino, range(1, 65) t(i)",
        "vec_cosine": f"WITH {_D}, {_C} SELECT dino.token, round(list_dot_product(dino.v, clip.v), 6) AS sim FROM dino JOIN clip USING (token)",
        "manifest_hash": f"SELECT run_id, {_SHA} AS manifest_sha256 FROM curation_set",
        "near_dup_pairs": f"WITH {_D}, {_E} SELECT a, b, round(sim, 6) AS sim FROM e",
        "near_dup_components": f"WITH RECURSIVE {_GROUPS} SELECT token, root FROM r",
        "near_dup_groups": f"""WITH RECURSIVE {_GROUPS}, g AS (SELECT root, list_sort(list(token)) AS l, count(*) AS n FROM r GROUP BY 1),
          z AS (SELECT x.root, sum(list_dot_product(dx.v, dy.v)) AS z FROM r x JOIN r y ON x.root = y.root AND x.token <> y.token JOIN dino dx ON dx.token = x.token JOIN dino dy ON dy.token = y.token GROUP BY 1)
          SELECT root AS representative, {_JOIN.format("l")} AS members, n::INT AS n_members, round(z / (n * n), 6) AS mean_similarity, round(z / (n * (n - 1)), 6) AS mean_pairwise_similarity FROM g JOIN z USING (root)""",
        "dropped_duplicates": f"WITH RECURSIVE {_GROUPS}, {_DROP} SELECT sample_token FROM dropped",
        "surviving_samples": f"WITH RECURSIVE {_GROUPS}, {_DROP} SELECT DISTINCT sample_token FROM samples WHERE sample_token IS NOT NULL AND sample_token NOT IN (SELECT sample_token FROM dropped)",
        "duplicates_json": f"""WITH RECURSIVE {_GROUPS} SELECT '{{"representative":"' || root || '","members":["' || list_aggregate(list_sort(list(token)), 'string_agg', '","') || '"]}}' AS json FROM r GROUP BY root""",
        "api_near_duplicates": f"SELECT run_id, representative, len(members)::INT AS n_members FROM duplicate_groups WHERE len(members) >= 3 ORDER BY len(members) DESC, run_id, representative NULLS FIRST, {_JOIN.format('members')} LIMIT 50",
        "dup_gallery": f"""WITH {_S}, t AS (SELECT * FROM duplicate_groups WHERE representative IS NOT NULL ORDER BY len(members) DESC NULLS LAST, run_id, representative, {_JOIN.format("members")} LIMIT 12)
          SELECT run_id, representative, coalesce(scene_name, representative) AS title, {_JOIN.format("members[1:10]")} AS shown FROM t LEFT JOIN s ON sample_token = representative""",
        "knn_distance": f"WITH {_C}, {_K} SELECT sample_token, knn_distance FROM k",
        "outliers": f"WITH {_C}, {_K}, {_O} SELECT sample_token, knn_distance, rank FROM o",
        "api_outliers": f"WITH {_C}, {_K}, {_O} SELECT sample_token, knn_distance, rank FROM o WHERE rank < 50",
        "outlier_gallery": f"WITH {_S}, {_C}, {_K}, {_O} SELECT o.sample_token, knn_distance, rank, scene_name, weather FROM o LEFT JOIN s USING (sample_token) WHERE rank < 12",
        "exact_topk": f"WITH {_C}, q AS (SELECT * FROM clip ORDER BY token LIMIT 1) {_TOPK.format('q, clip c')}",
        "exact_topk_batch": f"WITH {_C}, {_Q} {_TOPK.format('q, clip c')}",
        "text_search": f"""WITH {_S}, w AS (SELECT sample_token, min(clip_image)::DOUBLE[] AS v FROM encoded_batch WHERE sample_token IS NOT NULL AND len(clip_image) = 64 AND len(list_filter(clip_image, lambda x: x <> 0)) > 0 GROUP BY 1), q AS (SELECT clip_text::DOUBLE[] AS q FROM failure_prompts WHERE prompt_id = 1),
          b AS (SELECT sample_token, round(list_dot_product(v, q) / (sqrt(list_dot_product(v, v)) * (sqrt(list_dot_product(q, q)) + 1e-8) + 1e-8), 6) AS score FROM w, q ORDER BY score DESC, sample_token LIMIT 12)
          SELECT sample_token, scene_name, weather, score FROM s JOIN b USING (sample_token)""",
        "ivf_topk": f"WITH {_C}, {_P}, {_Q}, {_IVF} {_IVFK}",
        "recall_at_k": f"WITH {_C}, {_P}, {_Q}, {_IVF}, exact AS ({_TOPK.format('q, clip c')}), found AS ({_IVFK}) SELECT round((SELECT count(*) FROM exact JOIN found USING (query, token)) / (SELECT count(*) FROM exact)::DOUBLE, 4) AS recall",
        "cluster_sizes": f"WITH {_C}, {_P}, {_M} SELECT cluster_id, count(*) AS size, (SELECT count(*) FROM m) AS total FROM m GROUP BY 1",
        "cluster_centroids": f"""WITH {_C}, {_P}, {_M}, a AS (SELECT cluster_id, i, avg(v[i]) AS x FROM m JOIN clip ON token = sample_token, range(1, 65) t(i) GROUP BY 1, 2)
          SELECT cluster_id, (i - 1)::INT AS pos, round(x / (sqrt(sum(x * x) OVER (PARTITION BY cluster_id)) + 1e-8), 6) AS x FROM a""",
        "cluster_centroid_2d": f"WITH {_C}, {_P}, {_M} SELECT cluster_id, round(avg(v[1]), 6) AS x, round(avg(v[2]), 6) AS y FROM m JOIN clip ON token = sample_token GROUP BY 1",
        "label_clusters": f"""WITH {_C}, {_P}, {_M}, a AS (SELECT cluster_id, i, avg(v[i]) AS x FROM m JOIN clip ON token = sample_token, range(1, 65) t(i) GROUP BY 1, 2),
          n AS (SELECT cluster_id, list(x ORDER BY i) AS w FROM a GROUP BY 1), c AS (SELECT cluster_id, list_transform(w, lambda x: x / (sqrt(list_dot_product(w, w)) + 1e-8)) AS w FROM n)
          SELECT cluster_id, prompt_id, prompt AS label, round(list_dot_product(w, v), 6) AS score FROM c, p QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY round(list_dot_product(w, v), 10) DESC, prompt_id) = 1""",
        "clusters_ranked": f"WITH {_C}, {_P}, {_M} SELECT cluster_id, count(*) AS size, (row_number() OVER (ORDER BY count(*) DESC, cluster_id) - 1)::INT AS rank FROM m GROUP BY 1",
        "cluster_sample_2d": f"WITH {_C}, {_P}, {_M} SELECT cluster_id, sample_token, (row_number() OVER (PARTITION BY cluster_id ORDER BY sample_token))::INT AS idx, round(v[1], 6) AS x, round(v[2], 6) AS y FROM m JOIN clip ON token = sample_token QUALIFY idx <= 25",
        "noise_filter": f"WITH {_C}, {_P}, {_M} SELECT sample_token, cluster_id FROM m WHERE round(sim, 6) >= 0.2",
        "token_to_cluster": "SELECT DISTINCT run_id, cluster_id, unnest(members) AS sample_token FROM clusters",
        "cluster_series": "WITH c AS (SELECT cluster_id, unnest(sample_2d) AS p FROM clusters WHERE run_id = (SELECT max(run_id) FROM clusters)) SELECT cluster_id, p.sample_token AS sample_token, round(p.x, 6) AS x, round(p.y, 6) AS y, count(*) OVER w AS n, round(avg(p.x) OVER w, 6) AS mean_x, round(avg(p.y) OVER w, 6) AS mean_y FROM c WINDOW w AS (PARTITION BY cluster_id)",
        "stratified_take": f"WITH RECURSIVE {_ALL} SELECT cluster_id, cluster_rank, sample_token, member_idx FROM taken",
        "boosted_outliers": f"WITH RECURSIVE {_ALL} SELECT sample_token, rank FROM boosted",
        "per_cluster_kept": f"WITH RECURSIVE {_ALL} SELECT cluster_id, (SELECT count(*) FROM taken t WHERE t.cluster_id = sizes.cluster_id) AS kept FROM sizes",
        "curation_set": f"""WITH RECURSIVE {_ALL}, u AS (SELECT 0 AS a, cluster_rank AS b, member_idx AS c, sample_token FROM taken UNION ALL (SELECT 1, rank, 0, sample_token FROM boosted ORDER BY rank LIMIT 12)),
          f AS (SELECT sample_token, min((a, b, c)) AS nth FROM u GROUP BY 1) SELECT (row_number() OVER (ORDER BY nth, sample_token) - 1)::INT AS position, sample_token FROM f QUALIFY position < 120""",
        "curation_set_unclustered": f"WITH RECURSIVE {_GROUPS}, {_DROP} SELECT (row_number() OVER (ORDER BY sample_token) - 1)::INT AS position, sample_token FROM (SELECT DISTINCT sample_token FROM samples WHERE sample_token IS NOT NULL AND sample_token NOT IN (SELECT sample_token FROM dropped)) QUALIFY position < 120",
        "summary": f"""WITH {_SUMMARY} SELECT 0.97::DOUBLE AS duplicate_threshold, 120::INT AS target_size, n AS n_input_samples, sc AS n_scenes, g AS n_duplicate_groups, m AS n_samples_in_duplicate_groups, round(100.0::DOUBLE * m / greatest(1, n), 2) AS duplicate_rate_pct,
          o AS n_outliers, cl AS n_clusters, k AS n_curated, 'Curated ' || n || ' raw frames → ' || k || ' high-value training samples; flagged ' || round(100.0::DOUBLE * m / greatest(1, n), 1) || '% near-duplicates; surfaced ' || cl || ' failure-mode clusters.' AS headline_metric FROM c""",
        "lineage_timeline": f"SELECT run_id, substr({_SHA}, 1, 8) AS sha8, substr({_SHA}, 1, 32) AS sha32, coalesce(len(kept), 0)::INT AS n_kept, coalesce(len(dropped_duplicates), 0)::INT AS n_dropped FROM curation_set",
        "lineage_history": "SELECT run_id, target_size, coalesce(len(kept), 0)::INT AS n_kept, coalesce(len(dropped_duplicates), 0)::INT AS n_dropped FROM curation_set",
        "lineage_record": f"""WITH {_SUMMARY}, h AS (SELECT sha256(string_agg(t || chr(10), '' ORDER BY t)) AS sha FROM (SELECT DISTINCT unnest(kept) AS t FROM curation_set))
          SELECT 'run-20250101T000000Z-' || substr(sha, 1, 8) AS run_id, '20250101T000000Z' AS timestamp_utc, n::INT AS n_input_samples, k::INT AS n_curated_samples, g::INT AS n_duplicate_groups, o::INT AS n_outliers, cl::INT AS n_clusters, 0.97::DOUBLE AS duplicate_threshold, 120::INT AS target_size, sha AS manifest_sha256 FROM c, h""",
    }
