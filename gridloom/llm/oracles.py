"""DuckDB statements of the corpus queries that SQL can express."""

from __future__ import annotations

import string

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP1 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS k
        FROM d, unnest(range(1, len(ws) - 6)) AS u(i)),
twice AS (SELECT doc_id, k FROM win GROUP BY doc_id, k HAVING count(*) > 1),
hit AS (SELECT DISTINCT win.doc_id, i + o AS p FROM win JOIN twice USING (doc_id, k), unnest(range(8)) AS v(o)),
rep AS (SELECT doc_id, count(*) AS n FROM hit GROUP BY doc_id),
line AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dup FROM line
          WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(lines.dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
             coalesce(lines.n, 0) AS n_lines,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
             length(regexp_replace(t, '[^a-z]', '', 'g')) AS n_lower,
             length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclaim,
             len(list_filter(ws, lambda w: regexp_matches(w, '[#*$%&|<>]'))) AS n_symbol_words
      FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, CAST(
        CASE WHEN n_words < 20 THEN 1 ELSE 0 END
      + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
      + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
      + CASE WHEN 5 * n_symbol_words > n_words THEN 8 ELSE 0 END
      + CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 16 ELSE 0 END
      + CASE WHEN n_upper > n_lower THEN 32 ELSE 0 END
      + CASE WHEN 10 * n_exclaim > n_words THEN 64 ELSE 0 END
      + CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words) THEN 128 ELSE 0 END
      AS BIGINT) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed, 'v2' AS policy
FROM f
"""

_OP5 = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS lead FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND lead < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND lead < page_id THEN lead END AS refers_to
FROM g
"""

_OP9 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS k
        FROM d, unnest(range(1, len(ws) - 11)) AS u(i)),
lead AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
gone AS (SELECT DISTINCT win.doc_id, i + o AS p FROM win JOIN lead USING (k), unnest(range(13)) AS v(o)
         WHERE lead.m < win.doc_id),
word AS (SELECT doc_id, generate_subscripts(ws, 1) AS p, unnest(ws) AS w FROM d),
left_over AS (SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n
              FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(l.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(l.t, '')) AS kept_sha256
FROM d LEFT JOIN left_over l USING (doc_id)
"""

_OP13 = rf"""
WITH l AS (SELECT doc_id, CAST(max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS BIGINT) AS good,
                  CAST(max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS BIGINT) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT documents.doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_WORDS} AS ws,
             coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             min(documents.doc_id) OVER (PARTITION BY coalesce(text, '')) AS original
      FROM documents LEFT JOIN l USING (doc_id)),
fails AS (SELECT part, good, toxic,
                 CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END
              || CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END
              || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
              || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
              || CASE WHEN original < doc_id THEN 'E' ELSE '' END AS failed FROM d),
c AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, failed),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
o AS (SELECT a.k || b.k || x.k || y.k || z.k AS filter_order FROM f a, f b, f x, f y, f z
      WHERE len(list_distinct([a.k, b.k, x.k, y.k, z.k])) = 5),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS k,
             substr(filter_order, 1, step - 1) AS before FROM o, range(1, 6) AS r(step)),
hit AS (SELECT part, filter_order, step, k, n, good, toxic, contains(failed, k) AS fails, failed = k AS only_this,
               before <> '' AND regexp_matches(failed, '[' || before || 'x]') AS gone FROM c, s),
g AS (SELECT part, filter_order, step, any_value(k) AS k,
             sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN only_this THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
      FROM hit GROUP BY part, filter_order, step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley
FROM g
"""

#: Levels of the trees in SQL: enough for 16**8 rows.
_LEVELS = 8


def _field(name: str) -> str:
    return f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR), '-')"


def _tree(name: str, key: str) -> str:
    """Relations name0 (key, pos, digest) to name8, each holding the parents of the one before."""
    return ",\n".join(f"""
{name}{i + 1} AS (SELECT {key}, pos // 16 AS pos, any_value(n) AS n, CASE WHEN any_value(n) = 1 THEN any_value(digest)
                 ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest, string_agg(digest, ',' ORDER BY pos) AS kids
          FROM (SELECT {key}, pos, digest, count(*) OVER (PARTITION BY {key}) AS n FROM {name}{i}) GROUP BY {key}, pos // 16)"""
                      for i in range(_LEVELS))


def _steps(name: str, key: str, child: str) -> str:
    """Joins from a node with a position ``pos`` to the parents on every level."""
    return " ".join(f"JOIN {name}{i + 1} AS {name}_{i + 1} ON {name}_{i + 1}.{key} IS NOT DISTINCT FROM {child}.{key} "
                    f"AND {name}_{i + 1}.pos = {child}.pos // {16 ** (i + 1)}" for i in range(_LEVELS))


def _sides(name: str, child: str) -> list[tuple[str, str]]:
    """Digests to the left and to the right on every level; none where the tree has ended."""
    out = []
    for i in range(_LEVELS):
        kids, slot = f"string_split({name}_{i + 1}.kids, ',')", f"(({child}.pos // {16 ** i}) % 16)"
        out.append((f"CASE WHEN {name}_{i + 1}.n = 1 THEN NULL ELSE array_to_string(list_slice({kids}, 1, {slot}), '') END",
                    f"CASE WHEN {name}_{i + 1}.n = 1 THEN NULL ELSE array_to_string(list_slice({kids}, {slot} + 2, 16), '') END"))
    return out


_CRC32 = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(8 * strlen(CAST(doc_id AS VARCHAR))),
        lambda i: CASE WHEN i % 8 = 0 THEN CAST(ascii(substr(CAST(doc_id AS VARCHAR), 1 + i // 8, 1)) AS BIGINT) ELSE 0 END)),
        lambda c, x: CASE WHEN xor(c, x) & 1 = 1 THEN xor(xor(c, x) >> 1, 3988292384) ELSE xor(c, x) >> 1 END)"""


def _op11() -> str:
    text = _field("text")
    other = "".join(f"{_field(c)} || " for c in ("doc_id", "source", "lang", "n_chars"))
    lowered = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    sides = _sides("t", "l") + _sides("u", "s")
    listed = ", ".join(f"{a} AS l{i}, {b} AS r{i}" for i, (a, b) in enumerate(sides))
    chain = ["w0 AS (SELECT *, coalesce(tampered, leaf) AS f0 FROM p)"]
    for i in range(len(sides)):
        chain.append(f"w{i + 1} AS (SELECT * REPLACE (CASE WHEN l{i} IS NULL THEN f0 ELSE sha256(l{i} || f0 || r{i}) END AS f0) "
                     f"FROM w{i})")
    proof = " || ".join(f"coalesce(l{i} || r{i}, '')" for i in range(len(sides)))
    return f"""
WITH d AS (SELECT doc_id, source, sha256({other}{text}) AS leaf,
                  CASE WHEN xor({_CRC32}, 4294967295) % 5 = 0 THEN sha256({other}{text.replace('text', lowered)}) END AS tampered
           FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
t0 AS (SELECT source, pos, leaf AS digest FROM l),{_tree("t", "source")},
s AS (SELECT 1 AS one, source, digest, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos FROM t{_LEVELS}),
u0 AS (SELECT one, pos, digest FROM s),{_tree("u", "one")},
p AS (SELECT l.doc_id, l.leaf, l.tampered, s.digest AS subroot, u_{_LEVELS}.digest AS root, {listed}
      FROM l JOIN s ON s.source IS NOT DISTINCT FROM l.source {_steps("t", "source", "l")} {_steps("u", "one", "s")}),
{", ".join(chain)}
SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, f0 AS folded_root, f0 = root AS verified
FROM w{len(sides)}
"""


ORACLES: dict[str, str] = {"op1_quality_rules": _OP1, "op5_warc": _OP5, "op9_substring_dedup": _OP9, "op11_merkle_manifest": _op11(),
                           "op13_filter_audit": _OP13}
