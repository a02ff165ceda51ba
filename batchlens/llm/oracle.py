"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

from batchlens.llm import quality
from batchlens.llm.words import BLANKS, LOWER, NOT_ALNUM, UPPER

_WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), '{BLANKS}'), lambda x: x <> '')"
_FOLDED = f"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                                '{NOT_ALNUM}'), lambda x: x <> '')"""

JACCARD = f"""
    WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, w[p:p + k - 1] AS shingle
          FROM (SELECT doc_id, w, least(5, len(w)) AS k,
                       unnest(range(1, len(w) - least(5, len(w)) + 2)) AS p
                FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
    pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
              FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY x, y),
    l AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
          WHERE 5 * shared >= 4 * (nx.size + ny.size - shared)),
    e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
    reach AS (SELECT DISTINCT x AS node, x AS seen FROM e
              UNION SELECT node, y FROM reach JOIN e ON seen = x),
    c AS (SELECT node, min(seen) AS class_id FROM reach GROUP BY node),
    k AS (SELECT x AS node, count(*) AS n_links FROM e GROUP BY x)
    SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n_links, 0) AS n_links
    FROM documents LEFT JOIN c ON doc_id = c.node LEFT JOIN k ON doc_id = k.node"""

_LOWERED = _WORDS.replace("coalesce(text, '')", f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")

MINHASH = f"""
    WITH RECURSIVE d AS (SELECT doc_id, {_LOWERED} AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, w[p:p + k - 1] AS shingle
          FROM (SELECT doc_id, w, least(2, len(w)) AS k,
                       unnest(range(1, len(w) - least(2, len(w)) + 2)) AS p
                FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
    pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
              FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY x, y),
    l AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
          WHERE 100 * shared >= 80 * (nx.size + ny.size - shared)),
    e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
    reach AS (SELECT DISTINCT x AS node, x AS seen FROM e
              UNION SELECT node, y FROM reach JOIN e ON seen = x),
    c AS (SELECT node, min(seen) AS least FROM reach GROUP BY node)
    SELECT doc_id, coalesce(size, 0) AS n_shingles, coalesce(least, doc_id) AS component_id,
           coalesce(least, doc_id) = doc_id AS kept
    FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c ON doc_id = c.node"""

PHRASES = f"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                      unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                                   '[.,;:!?\\x0A-\\x0D]')) AS piece
               FROM documents),
    t AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w
          FROM p),
    n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM t GROUP BY lang),
    spots AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
              FROM t, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k),
    g AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*) AS f
          FROM spots GROUP BY ALL HAVING count(*) >= 100),
    c AS (SELECT lang, phrase, k, f, string_split(phrase, ' ') AS w FROM g WHERE k > 1),
    cuts AS (SELECT lang, phrase, f AS a, j, array_to_string(w[:j], ' ') AS head,
                    array_to_string(w[j + 1:], ' ') AS rest
             FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
    scored AS (SELECT cuts.lang, cuts.phrase, a, j, x.f AS l, y.f AS r, n,
                      CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
               FROM cuts JOIN g x ON x.lang = cuts.lang AND x.phrase = head
               JOIN g y ON y.lang = cuts.lang AND y.phrase = rest JOIN n ON n.lang = cuts.lang),
    least AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o
                             FROM scored) WHERE o = 1),
    inside AS (SELECT DISTINCT c.lang, array_to_string(c.w[i:i + m - 1], ' ') AS phrase, c.f
               FROM c, (SELECT unnest([2, 3, 4]) AS m), (SELECT unnest([1, 2, 3, 4]) AS i)
               WHERE m < c.k AND i + m - 1 <= c.k),
    most AS (SELECT lang, phrase, max(f) AS most FROM inside GROUP BY lang, phrase),
    kept AS (SELECT least.* FROM least LEFT JOIN most USING (lang, phrase) WHERE most IS NULL OR most < a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
               FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000"""

CONTAMINATION = f"""
    WITH d AS (SELECT doc_id, {_FOLDED} AS w FROM documents),
    i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_FOLDED} AS w FROM benchmark),
    windows AS (SELECT DISTINCT item, k, w[p:p + k - 1] AS win
                FROM (SELECT item, w, least(13, len(w)) AS k,
                             unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p
                      FROM i WHERE len(w) > 0)),
    spots AS (SELECT doc_id, p, k, w[p:p + k - 1] AS win
           FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
                 FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
    hits AS (SELECT doc_id, p, spots.k, item FROM spots JOIN windows USING (win)),
    covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit
                FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY doc_id),
    found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
              FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""

SUBSTRINGS = f"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
    spots AS (SELECT r, doc_id, p, w[p:p + 12] AS win
           FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d)),
    firsts AS (SELECT win, min(doc_id) AS least FROM spots GROUP BY win),
    gone AS (SELECT DISTINCT r, unnest(range(p, p + 13)) AS q
             FROM spots JOIN firsts USING (win) WHERE least < doc_id),
    each AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d),
    kept AS (SELECT r, string_agg(word, ' ' ORDER BY q) AS text, count(*) AS n
             FROM each ANTI JOIN gone USING (r, q) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
           sha256(coalesce(text, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (r)"""


def _quality(most_lost: float = 0.03, error: float = 0.1) -> str:
    rules = quality.GRIDS
    scores = {
        "symbols": "n_symbols / greatest(n_words, 1)",
        "lines": "n_dup_lines / greatest(n_lines, 1)",
        "word_length": "word_chars / greatest(n_words, 1)",
    }
    scored = " UNION ALL ".join(
        f"SELECT doc_id, lang, '{name}' AS rule, {scores[name]} AS score FROM f WHERE NOT base_failed"
        for name in rules
    )
    grid = " UNION ALL ".join(
        f"SELECT '{name}' AS rule, unnest({list(map(float, cuts))}) AS cutoff" for name, cuts in rules.items()
    )
    allowed = most_lost / len(rules)
    chance = f"""exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1)
                     + i * ln({allowed}) + (n_good - i) * ln(1 - {allowed}))"""
    return f"""
    WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS text, {_WORDS} AS words,
                      list_filter(string_split(coalesce(text, ''), chr(10)),
                                  lambda s: regexp_matches(s, '[^\\x20\\x09-\\x0D]')) AS lines
               FROM documents),
    tri AS (SELECT doc_id, i, words[i:i + 2] AS t
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
    often AS (SELECT doc_id, t FROM tri GROUP BY doc_id, t HAVING count(*) > 1),
    rep AS (SELECT doc_id, count(DISTINCT q) AS n
            FROM (SELECT doc_id, unnest(range(i, i + 3)) AS q FROM tri JOIN often USING (doc_id, t))
            GROUP BY doc_id),
    c AS (SELECT doc_id, lang, CAST(len(words) AS BIGINT) AS n_words,
                 CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT)
                     AS word_chars,
                 length(text) - length(translate(text, '{quality.SYMBOLS}', '')) AS n_symbols,
                 len(lines) AS n_lines,
                 CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                 coalesce(rep.n, 0) AS n_repeat_words
          FROM w LEFT JOIN rep USING (doc_id)),
    f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
    g AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
    s AS ({scored}),
    grid AS ({grid}),
    known AS (SELECT lang, rule, score, quality FROM s JOIN g USING (doc_id)),
    totals AS (SELECT lang, rule, count(*) FILTER (quality = 1) AS n_good FROM known GROUP BY lang, rule),
    tested AS (SELECT t.lang, t.rule, cutoff, n_good,
                      count(*) FILTER (score > cutoff AND quality = 1) AS lost,
                      count(*) FILTER (score > cutoff AND quality <> 1) AS caught
               FROM totals t JOIN grid USING (rule)
               JOIN known k ON k.rule = t.rule AND k.lang IS NOT DISTINCT FROM t.lang
               GROUP BY t.lang, t.rule, cutoff, n_good),
    bound AS (SELECT *, CASE WHEN lost > n_good * {allowed} THEN FALSE
                             WHEN lost >= n_good THEN FALSE
                             ELSE (SELECT sum({chance}) FROM unnest(range(0, lost + 1)) AS r(i))
                                  <= {error} / ((SELECT count(DISTINCT coalesce(lang, chr(0))) FROM totals) * {len(rules)})
                        END AS safe
              FROM tested),
    certified AS (SELECT *, bool_and(safe) OVER (PARTITION BY lang, rule ORDER BY cutoff DESC) AS ok
                  FROM bound),
    best AS (SELECT lang, rule, max({{'gain': caught - lost, 'cutoff': cutoff}}) AS b
             FROM certified WHERE ok AND caught > 0 GROUP BY lang, rule),
    over AS (SELECT DISTINCT doc_id FROM s JOIN best
             ON s.rule = best.rule AND s.lang IS NOT DISTINCT FROM best.lang
             WHERE b.gain > 0 AND score > b.cutoff)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND over.doc_id IS NULL AS kept
    FROM f LEFT JOIN over USING (doc_id)"""


ORACLE = {
    "op3_jaccard": JACCARD,
    "op4_quality": _quality(),
    "op6_decontamination": CONTAMINATION,
    "op11_minhash": MINHASH,
    "op12_phrases": PHRASES,
    "op7_substrings": SUBSTRINGS,
}
