"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from vantage.llm.license_scan import COPYRIGHT, SIGNS
from vantage.llm.license_texts import NOTICES, SPELLINGS, TEXTS

OP1 = """
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, '')))) AS hash_key
  FROM documents
), named AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS turn
  FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, turn,
         CASE turn % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         source_size * 2.0::DOUBLE AS cap
  FROM named
), levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (ORDER BY cap / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), open_level AS (
  SELECT level FROM levels WHERE cap > level * weight ORDER BY cap / weight, turn LIMIT 1
), targets AS (
  SELECT source, source_size,
         CASE WHEN cap <= level * weight THEN cap ELSE (SELECT level FROM open_level) * weight END AS target
  FROM levels
), runs AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY hash_key, doc_id, size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), budgets AS (
  SELECT *, CAST(floor(target) AS BIGINT) AS budget,
         CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs
  FROM runs
)
SELECT doc_id, source, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - start)) AS BIGINT) AS taken
FROM budgets
"""

OP4 = """
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM n
"""

OP10 = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, line, no,
         regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS words
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS no FROM docs)
), judged AS (
  SELECT doc_id, line, no, len(words) AS n,
         len(words) > 0 AND (
           len(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) > 0.3 * len(words)
           OR (len(words) >= 5 AND len(regexp_replace(line, '[^!]', '', 'g')) > 0.5 * len(words))
           OR (len(words) >= 6 AND
               len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) > 0.25 * len(words))
           OR (len(words) <= 25 AND NOT regexp_matches(words[-1], '[.!?:;"''\\)»”’…。！？]$') AND
               (len(words) <= 3 OR len(list_filter(words, lambda w: NOT list_contains(['home', 'contact', 'about', 'login', 'register', 'search', 'menu', 'imprint', 'sitemap',
               'help', 'startseite', 'kontakt', 'impressum', 'anmelden', 'registrieren', 'suche', 'menü', 'datenschutz',
               'hilfe', 'accueil', 'connexion', 'inscription', 'recherche', 'mentions', 'légales', 'aide', 'inicio',
               'contacto', 'acceder', 'registrarse', 'buscar', 'menú', 'aviso', 'legal', 'ayuda'], lower(w)))) = 0))
           OR (len(words) <= 25 AND regexp_matches(lower(line),
               'accept cookies|all rights reserved|cookie policy|enable javascript|lorem ipsum'
               || '|privacy policy|skip to content|terms of service|terms of use|uses cookies'
               || '|cookies akzeptieren|alle rechte vorbehalten|cookie-richtlinie|javascript aktivieren|datenschutzerklärung'
               || '|zum inhalt springen|allgemeine geschäftsbedingungen|nutzungsbedingungen|verwendet cookies|accepter les cookies'
               || '|tous droits réservés|politique de cookies|activer javascript|politique de confidentialité|aller au contenu'
               || '|conditions générales|conditions d''utilisation|utilise des cookies|aceptar cookies|aceptar las cookies'
               || '|todos los derechos reservados|política de cookies|activar javascript|política de privacidad|saltar al contenido'
               || '|términos del servicio|términos y condiciones|utiliza cookies'))
         ) AS fails
  FROM lines
), per_line AS (
  SELECT doc_id, count(*) FILTER (n > 0) AS n_lines,
         count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines,
         count(*) FILTER (fails) AS n_removed_lines,
         coalesce(sum(n) FILTER (fails), 0) AS n_removed_words
  FROM judged GROUP BY doc_id
), w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM docs
), grams AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), repeated AS (
  SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM repeated, (VALUES (0), (1), (2)) AS s(k) GROUP BY doc_id
), base AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(len(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(c.n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN covered c USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND 100 * n_removed_words <= 30 * n_words AS kept,
       CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed_lines AS BIGINT) AS n_removed_lines,
       CAST(n_removed_words AS BIGINT) AS n_removed_words
FROM base JOIN per_line USING (doc_id)
"""



def _canonical(text: str) -> str:
    low = f"lower({text})"
    lines = f"regexp_replace({low}, '{COPYRIGHT}', ' ', 'g')"
    plain = f"' ' || trim(regexp_replace({lines}, '{SIGNS}', ' ', 'g')) || ' '"
    for old, new in SPELLINGS.items():
        plain = f"replace({plain}, ' {old} ', ' {new} ')"
    return f"trim({plain})"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _values(pairs: dict[str, str]) -> str:
    return ", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in sorted(pairs.items()))


OP6 = f"""
WITH texts(name, body) AS (VALUES {_values(TEXTS)}),
known AS (SELECT sha256({_canonical('body')}) AS digest, min(name) AS name FROM texts GROUP BY 1),
notice(line, name) AS (VALUES {_values(NOTICES)}),
forms AS (SELECT {_canonical('line')} AS form, min(name) AS name FROM notice GROUP BY 1),
docs AS (SELECT doc_id, coalesce(text, '') AS body, row_number() OVER () AS row FROM documents),
split AS (SELECT row, unnest(string_split(body, chr(10))) AS line FROM docs),
hits AS (
  SELECT s.row, count(*) AS n, string_agg(DISTINCT f.name, ',' ORDER BY f.name) AS names
  FROM split s JOIN forms f ON {_canonical('s.line')} = f.form
  WHERE regexp_matches(lower(s.line), 'licen[cs]e') GROUP BY 1
), canon AS (SELECT row, doc_id, sha256({_canonical('body')}) AS canonical_sha256 FROM docs)
SELECT c.doc_id, c.canonical_sha256, k.name AS license,
       CAST(coalesce(h.n, 0) AS BIGINT) AS n_notice_lines, coalesce(h.names, '') AS notices
FROM canon c LEFT JOIN known k ON c.canonical_sha256 = k.digest LEFT JOIN hits h USING (row)
"""

FINITE = "len(list_filter({0}, lambda c: c IS NULL OR NOT isfinite(c))) = 0"

OP11 = f"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), u AS (
  SELECT r, vec_id, e, sqrt(list_sum(list_transform(e, lambda c: c * c))) AS norm FROM v
  WHERE e IS NOT NULL AND {FINITE.format('e')}
), links AS (
  SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.r <> b.r AND a.norm > 0 AND b.norm > 0
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95 ELSE false END
), reach(a, b) AS (
  SELECT r, r FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
), least AS (
  SELECT reach.a, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a
)
SELECT v.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id,
       v.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN least ON least.a = v.r LEFT JOIN counts ON counts.a = v.r
"""

# floor of a quotient of whole numbers, the divisor positive
FLOOR = "CAST(({0} - ((({0} % {1}) + {1}) % {1})) // {1} AS BIGINT)"


def _code_rounds(rounds: int) -> str:
    """CTEs near<k> (nearest entries) and book<k + 1> of each round; near<rounds> comes last."""
    out = []
    for k in range(rounds + 1):
        out.append(f"""dist{k} AS MATERIALIZED (
  SELECT x.r, x.part, b.entry, CAST(sum((x.c - b.c) * (x.c - b.c)) AS BIGINT) AS d
  FROM x JOIN book{k} b ON b.part = x.part AND b.pos = x.pos GROUP BY x.r, x.part, b.entry
), near{k} AS MATERIALIZED (
  SELECT r, part, entry, d FROM dist{k}
  QUALIFY row_number() OVER (PARTITION BY r, part ORDER BY d, entry) = 1
)""")
        if k < rounds:
            out.append(f"""mean{k} AS (
  SELECT n.part, n.entry, x.pos, {FLOOR.format('sum(x.c)', 'count(*)')} AS c
  FROM near{k} n JOIN x ON x.r = n.r AND x.part = n.part GROUP BY n.part, n.entry, x.pos
), book{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m USING (part, entry, pos)
)""")
    return ", ".join(out)


OP12 = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
         row_number() OVER (ORDER BY vec_id ASC NULLS LAST, embedding) AS r
  FROM embeddings WHERE embedding IS NOT NULL AND {FINITE.format('embedding')}
), flat AS (
  SELECT r, len(e) // 16 AS w, unnest(e) AS c, generate_subscripts(e, 1) - 1 AS i FROM kept
), x AS MATERIALIZED (
  SELECT r, i // w AS part, i % w AS pos, CAST(floor(256 * c) AS BIGINT) AS c FROM flat
), book0 AS MATERIALIZED (
  SELECT part, r - 1 AS entry, pos, c FROM x WHERE r <= 64
), {_code_rounds(2)}, coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near2 GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book2) AS codebooks_sha256
FROM coded JOIN kept USING (r)
"""


def _cluster_rounds(rounds: int) -> str:
    out = []
    for k in range(rounds + 1):
        out.append(f"""near{k} AS MATERIALIZED (
  SELECT x.r, m.cluster, CAST(sum((x.c - m.c) * (x.c - m.c)) AS BIGINT) AS d
  FROM x JOIN mid{k} m ON m.pos = x.pos GROUP BY x.r, m.cluster
  QUALIFY row_number() OVER (PARTITION BY x.r ORDER BY d, m.cluster) = 1
)""")
        if k < rounds:
            out.append(f"""mean{k} AS (
  SELECT n.cluster, x.pos, {FLOOR.format('sum(x.c)', 'count(*)')} AS c FROM near{k} n JOIN x ON x.r = n.r GROUP BY n.cluster, x.pos
), mid{k + 1} AS MATERIALIZED (
  SELECT m.cluster, m.pos, coalesce(a.c, m.c) AS c FROM mid{k} m LEFT JOIN mean{k} a USING (cluster, pos)
)""")
    return ", ".join(out)


OP13 = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
         row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)) ASC NULLS LAST, embedding) AS r
  FROM embeddings WHERE len(embedding) = 64 AND {FINITE.format('embedding')}
), flat AS (
  SELECT r, unnest(e) AS c, generate_subscripts(e, 1) - 1 AS pos FROM kept
), x AS MATERIALIZED (
  SELECT r, pos, CAST(floor(64 * c) AS BIGINT) AS c FROM flat
), mid0 AS MATERIALIZED (
  SELECT r - 1 AS cluster, pos, c FROM x WHERE r <= 16
), {_cluster_rounds(3)}, facts AS (
  SELECT cluster, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY pos)) AS centroid_sha256 FROM mid3 GROUP BY cluster
)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near3 JOIN kept USING (r) JOIN facts USING (cluster)
"""

SQL = {
    "op1_mix_sources": OP1,
    "op4_exact_dedup": OP4,
    "op6_license_scan": OP6,
    "op10_quality_rules": OP10,
    "op11_embedding_dedup": OP11,
    "op12_vector_codes": OP12,
    "op13_centroid_clusters": OP13,
}
