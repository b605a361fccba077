"""The queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

from inkwell.llm import ball_hash, fill_middle, fingerprints, html_text, mixing, near_dup, packing, pii, quality, sharding, token_counts, vector_codes, warc


def queries() -> dict:
    return {
        "op1_packing": packing.op1_packing,
        "op2_html_extraction": html_text.op2_html_extraction,
        "op4_fingerprints": fingerprints.op4_fingerprints,
        "op5_warc": warc.op5_warc,
        "op3_mixing": mixing.op3_mixing,
        "op6_pii": pii.op6_pii,
        "op7_quality_rules": quality.op7_quality_rules,
        "op10_near_dup": near_dup.op10_near_dup,
        "op8_sharding": sharding.op8_sharding,
        "op9_token_counts": token_counts.op9_token_counts,
        "op11_simhash": ball_hash.op11_simhash,
        "op12_fill_in_middle": fill_middle.op12_fill_in_middle,
        "op13_vector_codes": vector_codes.op13_vector_codes,
    }


#: The fill-in-the-middle rows by lists of units; a unit list's slices make the parts.
FILL_IN_MIDDLE = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u, [('0x' || substr(s, 8 * i + 1, 8))::BIGINT for i in range(4)] AS h FROM t),
c AS (SELECT *, len(u) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, n, form, t, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""


def vector_codes_sql() -> str:
    """Rounds of assignments (a1, ...) and codebooks (c0, ...), each over all pairs of a part and an entry."""
    distance = "list_sum(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    assign = f"SELECT vec_id, label, part, any_value(q.v) AS v, min({distance})::BIGINT AS d, arg_min(c.entry, {distance} * 256 + c.entry) AS entry FROM q JOIN %s c USING (part) GROUP BY vec_id, label, part"
    sums = "SELECT part, entry, i, sum(x) AS s, count(*) AS n FROM (SELECT part, entry, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM %s) GROUP BY ALL"
    steps = [
        "k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "q AS MATERIALIZED (SELECT vec_id, label, p AS part, v[len(v) // 4 * p + 1:len(v) // 4 * (p + 1)] AS v FROM k, range(4) r(p))",
        "f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k ORDER BY vec_id LIMIT 256)",
        "c0 AS MATERIALIZED (SELECT part, entry, v FROM q JOIN f USING (vec_id))",
    ]
    for r in range(1, 5):
        steps += [
            f"a{r} AS MATERIALIZED ({assign % f'c{r - 1}'})",
            f"m{r} AS (SELECT part, entry, list(floor(s / n)::BIGINT ORDER BY i) AS v FROM ({sums % f'a{r}'}) GROUP BY ALL)",
            f"c{r} AS MATERIALIZED (SELECT part, entry, coalesce(m{r}.v, c.v) AS v FROM c{r - 1} c LEFT JOIN m{r} USING (part, entry))",
        ]
    steps += [
        f"a5 AS MATERIALIZED ({assign % 'c4'})",
        "h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c4)",
        "e AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a5 GROUP BY vec_id, label)",
    ]
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM e, h"


def oracle_sql() -> dict[str, str]:
    return {"op12_fill_in_middle": FILL_IN_MIDDLE, "op13_vector_codes": vector_codes_sql()}
