"""DuckDB SQL for the corpus queries that SQL can express, from literals of their own."""

from __future__ import annotations

OP1 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
runs AS (SELECT r, i, array_to_string(ws[i:i+7], ' ') AS k
         FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
twice AS (SELECT r, i FROM runs QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
again AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(ls) AS n_lines,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(again.n, 0)::BIGINT AS n_repeat_words,
             len(list_filter(range(1, len(ws)), lambda i: ws[i] = ws[i + 1])) AS n_adjacent,
             length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals
      FROM w LEFT JOIN again USING (r)),
b AS (SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
                 + CASE WHEN 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END
                 + CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END
                 + CASE WHEN 100 * n_adjacent > 20 * n_words THEN 16 ELSE 0 END
                 + CASE WHEN 100 * n_capitals > 50 * n_letters THEN 32 ELSE 0 END
                 + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 64 ELSE 0 END)::BIGINT AS failed_bits
      FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits,
       failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept FROM b
"""

OP2 = r"""
WITH slim AS (SELECT row_number() OVER () AS r, doc_id, source,
                     coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM slim GROUP BY source),
v AS (SELECT *, k % 3 + 1 AS w, 3 * n AS cap FROM s),
o AS (SELECT *, row_number() OVER q AS place, (SELECT sum(n) FROM s)::DOUBLE
             - coalesce(sum(cap) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS rest,
             sum(w) OVER (q ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS weight
      FROM v WHERE n > 0 WINDOW q AS (ORDER BY cap::DOUBLE / w, k)),
f AS (SELECT place, rest, weight FROM o WHERE rest * w < cap::DOUBLE * weight ORDER BY place LIMIT 1),
t AS (SELECT v.*, CASE WHEN v.n = 0 THEN 0.0 WHEN f.place IS NULL OR o.place < f.place THEN v.cap::DOUBLE
                       ELSE f.rest * v.w / f.weight END AS target
      FROM v LEFT JOIN o USING (k) LEFT JOIN f ON true),
part AS (SELECT * FROM t WHERE target < cap),
seat AS (SELECT k FROM (SELECT k, target / (2 * unnest(range((cap + 63) // 64)) + 1) AS quotient FROM part)
         QUALIFY row_number() OVER (ORDER BY quotient DESC, k) <= round((SELECT sum(target) FROM part) / 64)),
plan AS (SELECT t.*, (SELECT count(*) FROM seat WHERE seat.k = t.k) AS quota,
                n > 0 AND target >= cap AS is_full, greatest(1, least(65536, (n + 131071) // 131072)) AS shards FROM t),
alike AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, size ORDER BY r) - 1 AS nth FROM slim),
dealt AS (SELECT r, doc_id, size, k, n, target, quota, is_full, shards, nth,
                 md5(concat_ws('|', 'mix-1', doc_id::VARCHAR, size::VARCHAR, CASE WHEN nth >= 1024 THEN (nth // 1024)::VARCHAR END)) AS key
          FROM alike JOIN plan ON alike.source IS NOT DISTINCT FROM plan.source),
shard AS (SELECT *, ('0x' || substr(key, 1, 8))::BIGINT % shards AS shard FROM dealt),
sums AS (SELECT k, shard, any_value(quota) AS quota, bool_or(is_full) AS is_full, sum(size)::BIGINT AS shard_size
         FROM shard GROUP BY k, shard),
seat2 AS (SELECT k, shard FROM (SELECT k, shard, quota, shard_size::DOUBLE
                                       / (2 * unnest(range((3 * shard_size + 63) // 64)) + 1) AS quotient FROM sums)
          QUALIFY row_number() OVER (PARTITION BY k ORDER BY quotient DESC, shard) <= quota),
got AS (SELECT sums.k, sums.shard, shard_size, (CASE WHEN is_full THEN 3 * shard_size
               ELSE least(64 * coalesce(g, 0), 3 * shard_size) END)::BIGINT AS shard_taken
        FROM sums LEFT JOIN (SELECT k, shard, count(*) AS g FROM seat2 GROUP BY k, shard) USING (k, shard)),
laid AS (SELECT shard.*, shard_size, shard_taken, coalesce(sum(size) OVER (PARTITION BY k, shard ORDER BY key, doc_id, size, nth
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
         FROM shard JOIN got USING (k, shard))
SELECT doc_id, size, n AS source_size, target,
       (shard_taken // greatest(shard_size, 1) * size
        + greatest(0, least(shard_taken % greatest(shard_size, 1) - start, size)))::BIGINT AS taken FROM laid
"""

OP3 = r"""
WITH passage(kind, label, words, phrases) AS (VALUES
    (0, 'mit', 'under the mit license', 'under the mit license'),
    (0, 'apache-2', 'apache license version 2', 'apache license version 2'),
    (0, 'cc-by-nc', 'cc by nc', 'cc by nc'),
    (1, 'mit', 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files', 'permission is hereby granted free of charge'),
    (1, 'isc', 'permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted', 'permission to use copy modify and|distribute this software for any purpose with or without fee'),
    (1, 'apache-2', 'licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license', 'you may not use this file except in compliance with the license'),
    (1, 'bsd', 'redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met', 'redistribution and use in source and binary forms'),
    (1, 'bsd', 'redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer', 'redistributions of source code must retain'),
    (1, 'gpl-3', 'licensed under the gnu general public license version 3', 'gnu general public license version 3'),
    (1, 'gpl-2', 'licensed under the gnu general public license version 2', 'gnu general public license version 2'),
    (1, 'gpl-3', 'gnu general public license as published by the free software foundation either version 3 of the license', 'gnu general public license as published by the free software foundation|version 3'),
    (1, 'gpl-2', 'gnu general public license as published by the free software foundation either version 2 of the license', 'gnu general public license as published by the free software foundation|version 2'),
    (1, 'lgpl', 'under the terms of the gnu lesser general public license', 'gnu lesser general public license'),
    (1, 'agpl', 'under the terms of the gnu affero general public license', 'gnu affero general public license'),
    (1, 'mpl-2', 'subject to the terms of the mozilla public license v 2 0', 'mozilla public license'),
    (1, 'mpl-2', 'mozilla public license version 2 0', 'mozilla public license version 2 0'),
    (1, 'cc-by-sa', 'licensed under cc by sa 4 0', 'cc by sa'),
    (1, 'cc-by-nd', 'licensed under cc by nd 4 0', 'cc by nd'),
    (1, 'cc-by', 'creative commons attribution 4 0 international license', 'creative commons attribution 4 0'),
    (1, 'cc-by-sa', 'attribution sharealike 4 0 international', 'attribution sharealike 4 0 international'),
    (1, 'cc-by-nd', 'attribution noderivatives 4 0 international', 'attribution noderivatives 4 0 international'),
    (1, 'cc-by-nc', 'attribution noncommercial 4 0 international', 'attribution noncommercial 4 0 international'),
    (1, 'unlicense', 'this is free and unencumbered software released into the public domain', 'unencumbered software released into the public domain'),
    (1, 'all-rights-reserved', 'all rights reserved', 'all rights reserved')),
spdx(label, id) AS (VALUES ('mit', 'mit'), ('isc', 'isc'), ('apache-2', 'apache 2 0'), ('bsd', 'bsd 2 clause'), ('bsd', 'bsd 3 clause'),
    ('gpl-3', 'gpl 3 0'), ('gpl-2', 'gpl 2 0'), ('lgpl', 'lgpl'), ('agpl', 'agpl'), ('mpl-2', 'mpl 2 0'), ('cc-by', 'cc by 4 0'),
    ('cc-by-sa', 'cc by sa'), ('cc-by-nd', 'cc by nd'), ('cc-by-nc', 'cc by nc'), ('unlicense', 'unlicense')),
listed AS (SELECT * FROM passage UNION ALL
           SELECT 1, label, 'spdx license identifier ' || id, 'spdx license identifier ' || id FROM spdx),
template AS (SELECT kind, label, ws, list_transform(ps, lambda p: list_filter(range(len(ws)), lambda i: ws[i+1:i+len(p)] = p)[1]) AS pos, ps
             FROM (SELECT kind, label, string_split(words, ' ') AS ws,
                          list_transform(string_split(phrases, '|'), lambda x: string_split(x, ' ')) AS ps FROM listed)),
d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
near AS (SELECT r, w, kind, label, ws, pos, ps FROM d, template WHERE list_has_all(w, flatten(ps))),
place AS (SELECT r, kind, label, ws, w, p - pos[1] AS s, pos, ps FROM (SELECT *, unnest(range(len(w))) AS p FROM near)
          WHERE w[p+1:p+len(ps[1])] = ps[1]),
hit AS (SELECT r, kind, label, s, len(list_filter(range(len(ws)), lambda j: s + j >= 0 AND w[s+1+j] = ws[j+1]))::DOUBLE / len(ws) AS matched
        FROM place WHERE len(ps) = 1 OR w[s+pos[2]+1:s+pos[2]+len(ps[2])] = ps[2]),
ok AS (SELECT * FROM hit WHERE kind = 0 OR matched >= 0.5),
g AS (SELECT r, count(*) FILTER (WHERE kind = 0) AS n_base, min(s) FILTER (WHERE kind = 0) AS first_word,
             max(s) FILTER (WHERE kind = 0) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE kind = 0) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
             CASE WHEN bool_or(kind = 0) THEN 1.0 ELSE max(matched) END AS score FROM ok GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score FROM d LEFT JOIN g USING (r)
"""

OP7 = r"""
WITH rule(action, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
     ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
p AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3)
             ELSE '' END AS rest FROM pages),
q AS (SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
best AS (SELECT q.r, arg_max(rule.action, length(rule.host || rule.path)) AS action,
                arg_max(rule.host || rule.path, length(rule.host || rule.path)) AS rule
         FROM q JOIN rule ON (q.host = rule.host OR ends_with(q.host, '.' || rule.host)) AND starts_with(q.path, rule.path)
         GROUP BY q.r)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.action, CASE WHEN list_has_any(
         string_split_regex(host, '[.-]'), ['adult', 'betting', 'bets', 'casino', 'escort', 'gambling', 'jackpot', 'poker',
         'porn', 'slots', 'viagra', 'xxx']) THEN 'block' ELSE 'allow' END) AS verdict
FROM q LEFT JOIN best USING (r)
"""


OP11 = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
m AS (SELECT doc_id, part, CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
             + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE l.good) AS good, count(*) FILTER (WHERE l.toxic) AS toxic
      FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT a.name || b.name || g.name || h.name || i.name AS filter_order, [a.bit, b.bit, g.bit, h.bit, i.bit] AS bits
      FROM f a, f b, f g, f h, f i WHERE a.bit | b.bit | g.bit | h.bit | i.bit = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, list_sum([0] || bits[1:step - 1])::INTEGER AS before
      FROM (SELECT *, unnest(range(1, 6)) AS step FROM o)),
t AS (SELECT part, filter_order, step, bit, sum(n) FILTER (WHERE mask & (bit | before) = 0) AS kept,
             sum(n) FILTER (WHERE mask & bit > 0 AND mask & before = 0) AS removed,
             sum(n) FILTER (WHERE mask & bit > 0 AND mask & before > 0) AS redundant, sum(n) FILTER (WHERE mask = bit) AS unique_fails,
             sum(good) FILTER (WHERE mask & bit > 0 AND mask & before = 0) AS good_lost,
             sum(toxic) FILTER (WHERE mask & bit > 0 AND mask & before = 0) AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM t
"""


def _op12(rounds: int = 5) -> str:
    """Assignment and update, written out for every round."""
    def nearest(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (SELECT r, vec_id, any_value(x) AS x, min(64 * d + k) % 64 AS k, min(64 * d + k) // 64 AS d FROM
  (SELECT r, vec_id, v.x AS x, k, list_sum(list_transform(range(1, 65), lambda j: (v.x[j] - c{i}.x[j]) * (v.x[j] - c{i}.x[j])))::BIGINT AS d
   FROM v, c{i}) GROUP BY r, vec_id)"""

    def moved(i: int) -> str:
        return f"""c{i + 1} AS MATERIALIZED (SELECT c{i}.k, coalesce(n.x, c{i}.x) AS x FROM c{i} LEFT JOIN
  (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY j) AS x FROM
    (SELECT k, j, sum(x[j])::BIGINT AS s, count(*) AS n FROM (SELECT k, x, unnest(range(1, 65)) AS j FROM a{i}) GROUP BY k, j)
   GROUP BY k) n USING (k))"""

    parts = [f"{nearest(i)},\n{moved(i)}" for i in range(rounds)] + [nearest(rounds)]
    return r"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS k, x FROM
  (SELECT sha256('2:' || vec_id) AS h, x FROM v WHERE vec_id IS NOT NULL ORDER BY h LIMIT 40)),
""" + ",\n".join(parts) + f"""
SELECT vec_id, a{rounds}.k::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY a{rounds}.k)::BIGINT AS cluster_inertia,
       sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (k)
"""


def oracles() -> dict[str, str]:
    return {"op1_quality_rules": OP1, "op2_source_mix": OP2, "op3_license_scan": OP3, "op7_url_rules": OP7,
            "op11_filter_audit": OP11, "op12_bisector_clusters": _op12()}
