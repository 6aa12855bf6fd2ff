"""SQL equivalents of the queries that SQL can express."""

from __future__ import annotations

from strataflow.llm import mixing, secret_scan

_SIZE = r"len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))"
_NOISY = r"len(regexp_extract_all(text, '[#*$%&|<>{}=_~^\\]'))"
_WEIGHTS = ", ".join(str(w) for w in mixing.WEIGHTS)

MIXING = f"""
    WITH docs AS (
        SELECT row_number() OVER () AS row, doc_id, source, {_SIZE} AS size,
               greatest(0.25, 1.0 - cast({_NOISY} AS double) / greatest(length(text), 1) * 4) AS worth,
               (cast('0x' || substr(md5('mix|' || coalesce(cast(doc_id AS varchar), '') || '|' || text),
                                    1, 13) AS bigint) + 0.5::double) / 4503599627370496 AS draw
        FROM (SELECT doc_id, source, coalesce(text, '') AS text FROM documents)
    ), sources AS (
        SELECT source, source_size, {mixing.MOST_EPOCHS}::double * source_size AS cap,
               [{_WEIGHTS}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::double
               AS weight
        FROM (SELECT source, sum(size)::bigint AS source_size FROM docs GROUP BY source)
    ), rates AS (
        SELECT cap / weight AS bound,
               ((SELECT sum(source_size) FROM sources)
                - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
               / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
        FROM sources
    ), targets AS (
        SELECT source, source_size, least(cap, weight * coalesce(
                   (SELECT rate FROM rates WHERE rate <= bound ORDER BY bound LIMIT 1), 'inf'))
               AS target
        FROM sources
    ), placed AS (
        SELECT docs.*, source_size, target,
               coalesce(sum(size) OVER (PARTITION BY docs.source ORDER BY -ln(draw) / worth, doc_id, size
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::double AS passed,
               floor(target / greatest(source_size, 1)) AS epochs
        FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source
    )
    SELECT doc_id, source, size::bigint AS size, source_size, target,
           ((epochs + (passed + size / 2.0::double <= target - epochs * source_size
                       AND target - epochs * source_size > 0 AND size > 0)::int) * size)::bigint
           AS taken
    FROM placed"""


def _rule_sql(order: int, rule: secret_scan.SecretRule) -> str:
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    return f"""
        SELECT row, {order} AS kind_order, '{rule.kind}' AS kind, start, start + length(match) AS stop
        FROM (
            SELECT row, matches[k] AS match, parts[k] AS part,
                   list_sum([length(s) FOR s IN gaps[1:k]])
                   + coalesce(list_sum([length(s) FOR s IN matches[1:k - 1]]), 0) AS start
            FROM (
                SELECT row, regexp_extract_all(text, {pattern}) AS matches,
                       regexp_extract_all(text, {pattern}, {rule.group}) AS parts,
                       string_split_regex(text, {pattern}) AS gaps
                FROM docs WHERE regexp_matches(text, {pattern})
            ), unnest(range(1, len(matches) + 1)) AS t(k)
        ) WHERE length(part) >= {rule.least}"""


_RULES = "\n        UNION ALL".join(_rule_sql(k, r) for k, r in enumerate(secret_scan.RULES))
_BASE = len(secret_scan.BASE_KINDS)
_LIST = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, kind_order)"

SECRETS = f"""
    WITH docs AS (
        SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
    ), found AS ({_RULES}
    ), listed AS (
        SELECT row, count(*) FILTER (kind = 'assign') AS n_assign,
               count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
               {_LIST} FILTER (kind_order < {_BASE}) AS base, {_LIST} AS spans
        FROM found GROUP BY row
    )
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
           coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
           coalesce(spans, '') AS spans
    FROM docs LEFT JOIN listed USING (row)"""
