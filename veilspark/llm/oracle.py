"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from . import embeddedup, licenses, linededup, mixing

OP10 = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS s FROM documents),
g AS (SELECT s, max(doc_id) AS top, count(*) AS n FROM d GROUP BY s)
SELECT d.doc_id, CASE WHEN g.n = 1 THEN d.doc_id ELSE g.top END AS keep_id, g.n AS group_size,
       row_number() OVER (PARTITION BY d.s ORDER BY d.doc_id DESC NULLS LAST) = 1 AS kept, d.s AS text_sha256
FROM d JOIN g ON d.s = g.s
"""

OP4 = f"""
WITH page AS (SELECT DISTINCT source, text FROM documents),
site AS (SELECT source, count(*) AS texts FROM page GROUP BY source),
word_line AS (SELECT DISTINCT source, text, trim(unnest(string_split(text, chr(10))), chr(32) || chr(9) || chr(13)) AS bare FROM page),
held AS (SELECT source, bare, count(*) AS n FROM word_line WHERE bare <> '' GROUP BY source, bare),
gone AS (SELECT held.source, bare FROM held JOIN site ON held.source IS NOT DISTINCT FROM site.source
         WHERE n >= {linededup.MIN_PAGES} AND n::DOUBLE / texts > {linededup.RATIO}),
line AS (
  SELECT doc_id, source, pos, body, trim(body, chr(32) || chr(9) || chr(13)) AS bare
  FROM (SELECT doc_id, source, generate_subscripts(a, 1) AS pos, unnest(a) AS body
        FROM (SELECT doc_id, source, string_split(text, chr(10)) AS a FROM documents))),
marked AS (SELECT line.*, EXISTS (SELECT 1 FROM gone WHERE gone.bare = line.bare
                                  AND gone.source IS NOT DISTINCT FROM line.source) AS off FROM line),
rest AS (SELECT doc_id, string_agg(body, chr(10) ORDER BY pos) FILTER (WHERE NOT off) AS text,
                count(*) FILTER (WHERE off) AS dropped FROM marked GROUP BY doc_id)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(rest.text, '') END AS text,
       coalesce(rest.dropped, 0) AS dropped_lines
FROM documents d LEFT JOIN rest ON d.doc_id = rest.doc_id
"""


def _op8() -> str:
    """Known sentences as runs of words: every word and mark stands between two blanks of its own and marks come in
    pairs, so that neighbouring finds share no sign and no look-around is needed."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    names = dict((s, i) for i, s in licenses.SENTENCES)
    known = ", ".join(f"({q(s)}, {q(i)})" for s, i in names.items())
    rules = ", ".join(f"({n}, {q(lic)}, {q(kind)}, {q(licenses.rule_pattern(ids))})"
                      for n, (lic, kind, ids) in enumerate(licenses.RULES, 1))

    def run(sentence: str) -> str:
        words = "(  S)*  ".join(sentence.split())
        return f" [HS]  {words}  [HS] " if names[sentence] in licenses.WHOLE else f" {words} "

    runs = "|".join(run(s) for s in sorted(names, key=lambda s: -len(s)))
    return f"""
WITH known(sentence, id) AS (VALUES {known}),
rule(n, licence, kind, pattern) AS (VALUES {rules}),
ended AS (SELECT doc_id, regexp_replace(lower(regexp_replace(coalesce(text, ''), '[^\\x00-\\x7F]+', ' ', 'g')),
  '[.!?]+([ \\t\\r]|$|\\n)', ' H ', 'g') AS t FROM documents),
marks AS (SELECT doc_id, ' H ' || replace(regexp_replace(t, '\\n([^a-z0-9\\n]*\\n)+', ' H ', 'g'), chr(10), ' S ') || ' H ' AS t FROM ended),
spaced AS (SELECT doc_id, replace(replace(replace(regexp_replace(t, '[^a-z0-9HS]+', ' ', 'g'), ' ', '  '),
  ' H ', ' H  H '), ' S ', ' S  S ') AS t FROM marks),
found AS (SELECT doc_id, regexp_extract_all(t, '{runs}') AS a FROM spaced),
hit AS (SELECT doc_id, generate_subscripts(a, 1) AS pos, unnest(a) AS body FROM found),
named AS (SELECT doc_id, pos, id FROM hit JOIN known ON trim(regexp_replace(regexp_replace(body, '[HS]', ' ', 'g'), ' +', ' ', 'g')) = sentence),
seq AS (SELECT doc_id, string_agg(id, ' ' ORDER BY pos) AS ids FROM named GROUP BY doc_id),
first_rule AS (SELECT doc_id, min(n) AS n FROM seq JOIN rule ON regexp_matches(' ' || ids || ' ', pattern) GROUP BY doc_id)
SELECT d.doc_id, rule.licence, rule.kind AS licence_class, rule.n AS licence_rule, coalesce(seq.ids, '') AS sentence_ids
FROM documents d LEFT JOIN seq ON d.doc_id = seq.doc_id LEFT JOIN first_rule f ON d.doc_id = f.doc_id
LEFT JOIN rule ON rule.n = f.n
"""


def _op6() -> str:
    """Raking written out: every marginal of every round is one step over the cells."""
    m = mixing
    steps = [f"""
d AS (SELECT doc_id, source, lang, coalesce(source, '{m.NONE}') AS s, coalesce(lang, '{m.NONE}') AS l,
      coalesce(text, '') AS t, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\r\\n]+')) AS tokens,
      md5(coalesce(doc_id::VARCHAR, text, '') || '|{m.SEED}') AS draw FROM documents),
g AS (SELECT *, length(t) - length(replace(t, '|', '')) AS bars, length(t) - length(replace(t, '!', '')) AS calls,
      3 * length(t) - length(replace(t, '#', '')) - length(replace(t, '$', '')) - length(replace(t, '%', '')) AS signs
      FROM d),
doc AS (SELECT doc_id, source, lang, s, l, tokens, draw, CASE WHEN tokens = 0 THEN 'empty' WHEN bars * 5 > tokens THEN 'table'
        WHEN signs > tokens THEN 'noise' WHEN calls > tokens THEN 'shouting' WHEN tokens < 150 THEN 'note'
        WHEN tokens < 1000 THEN 'article' ELSE 'book' END AS k FROM g),
cell AS (SELECT s, l, k, sum(tokens)::DOUBLE AS tokens FROM doc GROUP BY ALL),
amount AS (SELECT sum(tokens) AS total FROM cell),
w0 AS (SELECT *, tokens AS weight FROM cell)"""]
    for d in "slk":
        steps.append(f"""
own_{d} AS (SELECT {d}, pow(sum(tokens), {m.POWER}) AS x FROM cell GROUP BY {d} HAVING sum(tokens) > 0),
aim_{d} AS (SELECT {d}, x / (SELECT sum(x) FROM own_{d}) AS share FROM own_{d})""")
    n = 0
    for _ in range(m.ROUNDS):
        for d in "slk":
            steps.append(f"""
w{n + 1} AS MATERIALIZED (SELECT w.s, w.l, w.k, w.tokens,
  w.weight * coalesce(aim.share * (SELECT total FROM amount) / nullif(sum(w.weight) OVER (PARTITION BY w.{d}), 0), 1.0) AS weight
  FROM w{n} w LEFT JOIN aim_{d} aim ON aim.{d} = w.{d})""")
            n += 1
    steps.append(f"""
r AS MATERIALIZED (SELECT *, CASE WHEN tokens > 0 THEN weight / tokens ELSE 1.0 END AS ratio FROM w{n}),
k0 AS (SELECT {m.BUDGET}::DOUBLE AS scale)""")
    for i in range(m.CAP_ROUNDS):
        steps.append(f"""
k{i + 1} AS MATERIALIZED (SELECT coalesce(({m.BUDGET} * (SELECT total FROM amount)
  - coalesce(sum(tokens) FILTER (WHERE ratio * scale >= 1), 0))
  / nullif(sum(weight) FILTER (WHERE ratio * scale < 1), 0), any_value(scale)) AS scale FROM r, k{i})""")
    return "WITH " + ",".join(steps) + f"""
SELECT doc.doc_id, doc.source, doc.lang, doc.k AS topic, doc.tokens, round(least(1.0, r.ratio * scale), 6) AS p,
       ('0x' || substr(doc.draw, 1, 8))::BIGINT / 4294967296.0 < least(1.0, r.ratio * scale) AS kept
FROM doc JOIN r ON r.s = doc.s AND r.l = doc.l AND r.k = doc.k, k{m.CAP_ROUNDS}
"""


OP9 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
         ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
         WHERE list_cosine_similarity(a.e, b.e) >= {embeddedup.COSINE}),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(least.b, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(least.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN least ON least.a = e.vec_id
"""

ORACLE: dict[str, str] = {"op4_line_dedup": OP4, "op6_mixing": _op6(), "op8_license_scan": _op8(),
                          "op9_embedding_dedup": OP9, "op10_exact_dedup": OP10}
