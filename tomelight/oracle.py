r"""The registered queries as SQL for DuckDB, written on their own.

DuckDB's expressions know no look-around and only ASCII classes behind ``\w`` and
``\b``; word edges are therefore consumed and restored, and zero-width splits go
through a marker character.
"""

from __future__ import annotations

import re

from .functions.constants import (
    INTENTS,
    PROMPT_TEMPLATE,
    SCOPE_ALL,
    SCOPE_ONE,
    STATS_SCOPE_ALL,
    STOP_WORDS,
)

WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
W = r"\p{L}\p{N}_"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def replace_all(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {quote(pattern)}, {quote(by)}, 'g')"


STOPS = "[" + ", ".join(quote(w) for w in STOP_WORDS) + "]"


def strip(text: str) -> str:
    return replace_all(text, f"^{WS}+|{WS}+$", "")


def squeeze(text: str) -> str:
    return replace_all(text, f"{WS}+", " ")


def clean(text: str) -> str:
    out = replace_all(squeeze(text), r"[\x00-\x1f\x7f-\x{9f}]", "")
    out = replace_all(out, r"(?i)(Página|Page) *\p{Nd}+", "")
    code = rf"(?i)(^|[^{W}])[A-Z]{{2,}}\p{{Nd}}+(?:[-_, ]+\p{{Nd}}*[A-Z]*\p{{Nd}}*($|[^{W}])|[-_, ]*\p{{Nd}}*[A-Z]*\p{{Nd}}*($|[^{W}]))"
    out = replace_all(out, code, r"\1\2\3")
    out = replace_all(out, rf"(?i)(^|[^{W}])Part +\p{{Nd}}+($|[^{W}])", r"\1\2")
    out = replace_all(out, rf"(^|[^{W}])\p{{Nd}}+-\p{{Nd}}+ +\p{{Nd}}+($|[^{W}])", r"\1\2")
    out = replace_all(
        out,
        rf"(?i)(^|[^{W}])(?:Hydraulic system|Functions and operation).*?valve \p{{Nd}}+\.?($|[^{W}])",
        r"\1\2",
    )
    return f"trim({replace_all(out, ' +', ' ')})"


def words(text: str) -> str:
    """White-space words."""
    return f"list_filter(string_split_regex({text}, {quote(WS + '+')}), lambda w: w <> '')"


def terms(text: str, least: int = 1) -> str:
    """Runs of letters, digits and underscores, lower-cased."""
    split = f"string_split_regex(lower({text}), {quote(f'[^{W}]+')})"
    return f"list_filter({split}, lambda w: length(w) >= {least})"


def no_stops(items: str) -> str:
    return f"list_filter({items}, lambda w: NOT list_contains({STOPS}, w))"


def tokens(text: str) -> str:
    out = replace_all(text, r"""(\.\.\.|--|[;@#$%&?!\]\[(){}<>"“”«»…])""", r" \1 ")
    out = replace_all(out, r"([:,])([^0-9]|$)", r" \1 \2")
    out = replace_all(out, r"""([^.])\.([\]\)}>"'»” ]*)( |$)""", r"\1 .\2\3")
    out = replace_all(
        out, r"([^' ])('(?:[sSmMdD]|ll|LL|re|RE|ve|VE)?|n't|N'T)( |$)", r"\1 \2\3"
    )
    return f"list_filter(string_split({out}, ' '), lambda w: w <> '')"


def stem(word: str) -> str:
    def ends(s):
        return f"suffix({word}, '{s}')"

    def cut(n):
        return f"left({word}, length({word}) - {n})"

    return f"""CASE WHEN length({word}) < 3 THEN {word}
        WHEN {ends("ies")} THEN
            CASE WHEN {ends("eies")} OR {ends("aies")} THEN {word} ELSE {cut(3)} || 'y' END
        WHEN {ends("es")} THEN
            CASE WHEN {ends("aes")} OR {ends("ees")} OR {ends("oes")} THEN {word} ELSE {cut(1)} END
        WHEN {ends("s")} THEN
            CASE WHEN {ends("us")} OR {ends("ss")} THEN {word} ELSE {cut(1)} END
        ELSE {word} END"""


def sentence_list(text: str) -> str:
    marked = replace_all(text, rf"([.!?]){WS}+", "\\1\x01")
    return f"list_filter(string_split({marked}, chr(1)), lambda s: s <> '')"


def bucket(word: str, n: str | int) -> str:
    return f"(('0x' || substr(md5({word}), 1, 8))::BIGINT % {n})"


CLEANED = f"""cleaned AS MATERIALIZED (
  SELECT doc_id, source AS filename, text AS raw_text, {clean("text")} AS clean_text FROM documents)"""

ANALYZED = f"""{CLEANED},
tokened AS MATERIALIZED (
  SELECT *, {tokens("clean_text")} AS tokens_original FROM cleaned),
lowered AS MATERIALIZED (
  SELECT *, list_transform(tokens_original, lambda w: lower(w)) AS tokens_lower FROM tokened),
alnum AS MATERIALIZED (
  SELECT *, list_filter(tokens_lower, lambda w: regexp_full_match(w, '[\\p{{L}}\\p{{N}}]+')) AS tokens_alnum
  FROM lowered),
kept AS MATERIALIZED (SELECT *, {no_stops("tokens_alnum")} AS tokens FROM alnum),
stemmed AS MATERIALIZED (
  SELECT *, list_transform(tokens, lambda w: {stem("w")}) AS tokens_stemmed FROM kept),
analyzed AS MATERIALIZED (
  SELECT *, {no_stops("tokens_stemmed")} AS lemmas, {sentence_list("clean_text")} AS sentences
  FROM stemmed),
processed AS MATERIALIZED (
  SELECT * FROM analyzed WHERE raw_text <> '' AND len(tokens) > 0)"""


def sparse_sql(
    source: str, id: str, list_: str, min_df: int, max_df: float, features: int, tag: str = ""
) -> str:
    """CTEs post, size, vocab, raw, weight for a table of term lists."""
    return f"""post{tag} AS MATERIALIZED (
  SELECT {id}, term, count(*) AS tf FROM (SELECT {id}, unnest({list_}) AS term FROM {source})
  GROUP BY ALL),
size{tag} AS MATERIALIZED (SELECT count(*) AS n FROM {source}),
vocab{tag} AS MATERIALIZED (
  SELECT term, (row_number() OVER (ORDER BY term) - 1)::INTEGER AS idx, df, cf FROM (
    SELECT term, count(*)::BIGINT AS df, sum(tf)::BIGINT AS cf FROM post{tag}
    GROUP BY term HAVING count(*) >= {min_df} AND count(*) <= {max_df} * (SELECT n FROM size{tag})
    ORDER BY cf DESC, term LIMIT {features})),
raw{tag} AS MATERIALIZED (
  SELECT {id}, term, idx, tf, tf * (ln((1 + n) / (1.0 + df)::DOUBLE) + 1) AS w
  FROM post{tag} JOIN vocab{tag} USING (term), size{tag}),
weight{tag} AS MATERIALIZED (
  SELECT {id}, term, idx, w / sqrt(sum(w * w) OVER (PARTITION BY {id})) AS weight FROM raw{tag})"""


LEMMA_TFIDF = f"""{ANALYZED},
{sparse_sql("processed", "doc_id", "lemmas", 2, 0.8, 1000)},
bow AS (SELECT doc_id, term, idx, tf::DOUBLE AS weight FROM raw)"""


def chunk_sql(starts: str, source: str = "documents", text: str = "text") -> str:
    """CTEs tidy, section, piece, chunk: the whole chunker."""
    section = rf"(?i)(\n{WS}*(?:{starts}))"
    return f"""tidy AS MATERIALIZED (
  SELECT doc_id, {strip(replace_all(replace_all(text, r"\n{3,}", chr(10) * 2), " +", " "))} AS text
  FROM {source} WHERE length({text}) >= 20),
section AS MATERIALIZED (
  SELECT doc_id, generate_subscripts(parts, 1) AS sec, unnest(parts) AS body FROM (
    SELECT doc_id, string_split({replace_all("text", section, chr(1) + chr(92) + "1")}, chr(1)) AS parts
    FROM tidy)),
worded AS MATERIALIZED (SELECT *, {words("body")} AS w FROM section),
piece AS MATERIALIZED (
  SELECT doc_id, sec, 0 AS start, {strip("body")} AS body FROM worded
  WHERE len(w) < 100 AND {strip("body")} <> ''
  UNION ALL
  SELECT doc_id, sec, start,
    CASE WHEN brk > 280 AND brk > 20 THEN left(win, brk + 1) ELSE win END AS body
  FROM (
    SELECT doc_id, sec, start, win,
      greatest(
        CASE WHEN contains(win, '.') THEN length(win) - instr(reverse(win), '.') ELSE -1 END,
        CASE WHEN contains(win, ':') THEN length(win) - instr(reverse(win), ':') ELSE -1 END) AS brk
    FROM (
      SELECT doc_id, sec, start, array_to_string(w[start + 1 : start + 400], ' ') AS win
      FROM (SELECT doc_id, sec, w, unnest(range(0, len(w), 350)) AS start FROM worded WHERE len(w) >= 100)))
  WHERE len(string_split(CASE WHEN brk > 280 AND brk > 20 THEN left(win, brk + 1) ELSE win END, ' ')) >= 100),
chunk AS MATERIALIZED (
  SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY sec, start) - 1)::INTEGER AS chunk_index,
    body AS chunk_text
  FROM piece)"""


DEFAULT_STARTS = (
    rf"\p{{Nd}}+\.{WS}+|[A-Z](?:[A-Z]|{WS})+:|CAUTION|WARNING|NOTE"
    rf"|Step{WS}+\p{{Nd}}+:|Section{WS}+\p{{Nd}}+"
)
SECTION = "the|les|der|que|los"
WARNING = "tion"
PROCEDURE = "The|Le|Die|El"
TAXONOMY = ["tion", "ment", "the", "sch", "que", "other"]


def flags(warning: str, procedure: str) -> str:
    first = strip("split_part(chunk_text, chr(10), 1)")
    return f"""regexp_matches(chunk_text, {quote("(?i)" + warning)}) AS is_warning,
  regexp_matches({first}, {quote("(?i)^(?:" + procedure + ")")}) AS is_procedure,
  (length(chunk_text) - length(replace(chunk_text, '|', '')) >= 4
    OR contains(chunk_text, ':\\s*\\d')) AS has_table,
  len({words("chunk_text")})::INTEGER AS num_words"""


DEFAULT_FLAGS = flags("⚠|WARNING|CAUTION|DANGER", rf"\p{{Nd}}+\.|Step{WS}+\p{{Nd}}+")

CHUNKS = f"""{chunk_sql(DEFAULT_STARTS)},
chunks AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY c.doc_id, chunk_index) - 1)::BIGINT AS chunk_id, c.doc_id,
    d.source AS filename, chunk_text, chunk_index, {DEFAULT_FLAGS}
  FROM chunk c JOIN documents d ON c.doc_id = d.doc_id)"""


def grams(text: str) -> str:
    base = no_stops(terms(text, 2))
    return f"""list_concat(u, list_transform(range(1, len(u)), lambda i: u[i] || ' ' || u[i + 1])) AS g
  FROM (SELECT *, {base} AS u"""


def hashed_sql(source: str, id: str, text: str, tag: str) -> str:
    """CTE vec: 64 signed bucket sums of the words, scaled to length one."""
    return f"""code{tag} AS MATERIALIZED (
  SELECT {id}, {bucket("t", 64)} AS dim,
    sum(CASE WHEN substr(md5(t), 9, 1) >= '8' THEN -1 ELSE 1 END)::DOUBLE AS x
  FROM (SELECT {id}, unnest({terms(text)}) AS t FROM {source}) GROUP BY ALL),
vec{tag} AS MATERIALIZED (
  SELECT {id}, list(v ORDER BY dim) AS v FROM (
    SELECT {id}, dim, coalesce(x / nullif(sqrt(sum(x * x) OVER (PARTITION BY {id})), 0), 0)::FLOAT::DOUBLE AS v
    FROM (SELECT i.{id}, d.dim, coalesce(c.x, 0.0) AS x
      FROM {source} i CROSS JOIN (SELECT unnest(range(64)) AS dim) d
      LEFT JOIN code{tag} c ON c.{id} = i.{id} AND c.dim = d.dim))
  GROUP BY {id})"""


INDEX = f"""{CHUNKS},
questions AS (SELECT item_id AS query_id, text FROM benchmark),
chunk_terms AS MATERIALIZED (
  SELECT chunk_id, {grams("chunk_text")} FROM chunks)),
query_terms AS MATERIALIZED (
  SELECT query_id, {grams("text")} FROM questions)),
{sparse_sql("chunk_terms", "chunk_id", "g", 1, 1.0, 2000)},
query_post AS (
  SELECT query_id, term, count(*) AS tf FROM (SELECT query_id, unnest(g) AS term FROM query_terms)
  GROUP BY ALL),
query_raw AS (
  SELECT query_id, term, idx, tf * (ln((1 + n) / (1.0 + df)::DOUBLE) + 1) AS w
  FROM query_post JOIN vocab USING (term), size),
query_weight AS MATERIALIZED (
  SELECT query_id, term, idx, w / sqrt(sum(w * w) OVER (PARTITION BY query_id)) AS weight FROM query_raw)"""

SCORES = f"""{INDEX},
{hashed_sql("chunks", "chunk_id", "chunk_text", "_c")},
{hashed_sql("questions", "query_id", "text", "_q")},
lexical AS MATERIALIZED (
  SELECT q.query_id, c.chunk_id, sum(q.weight * c.weight) AS s
  FROM query_weight q JOIN weight c USING (idx) GROUP BY ALL),
score AS MATERIALIZED (
  SELECT q.query_id, c.chunk_id, k.filename, list_inner_product(q.v, c.v) AS dense,
    coalesce(l.s, 0.0) AS lexical
  FROM vec_q q CROSS JOIN vec_c c JOIN chunks k ON k.chunk_id = c.chunk_id
  LEFT JOIN lexical l ON l.query_id = q.query_id AND l.chunk_id = c.chunk_id)"""


def top(by: str, k: int, where: str = "true") -> str:
    return f"""(SELECT query_id, rank, chunk_id, score FROM (
  SELECT query_id, chunk_id, {by} AS score, row_number() OVER (
    PARTITION BY query_id ORDER BY round({by}, 6) DESC, chunk_id)::INTEGER AS rank
  FROM score WHERE {where}) WHERE rank <= {k})"""


def hybrid(k: int, score: str = "0.7 * dense + (1 - 0.7) * lexical", join: str = "") -> str:
    return f"""(SELECT query_id, rank, chunk_id, score FROM (
  SELECT query_id, chunk_id, s AS score, row_number() OVER (
    PARTITION BY query_id ORDER BY round(s, 6) DESC, dense_rank)::INTEGER AS rank
  FROM (SELECT query_id, chunk_id, dense_rank, {score} AS s FROM (
    SELECT *, row_number() OVER (
      PARTITION BY query_id ORDER BY round(dense, 6) DESC, chunk_id) AS dense_rank FROM score) c
    {join} WHERE dense_rank <= {3 * k})) WHERE rank <= {k})"""


def methods(k: int) -> str:
    return f"""ranked AS MATERIALIZED (
  SELECT 'sbert' AS method, * FROM {top("dense", k)}
  UNION ALL SELECT 'tfidf', * FROM {top("lexical", k)}
  UNION ALL SELECT 'hybrid', * FROM {hybrid(k)})"""


def digest(v: str) -> str:
    return f"""round(list_sum({v}::DOUBLE[]), 6) AS v_sum,
  round(list_sum(list_transform({v}::DOUBLE[], lambda x, i: x * i)), 6) AS v_pos"""


LEMMA_VECTORS = f"""{ANALYZED},
lemma_count AS MATERIALIZED (
  SELECT term, count(*)::BIGINT AS freq FROM (SELECT unnest(lemmas) AS term FROM processed) GROUP BY term),
lemma_vector AS MATERIALIZED (
  SELECT term AS word, embedding::DOUBLE[] AS v
  FROM (SELECT term, {bucket("term", "(SELECT count(*) FROM embeddings)")} AS vec_id
    FROM lemma_count WHERE freq >= 2) JOIN embeddings USING (vec_id))"""

PAIRS = """pairs AS MATERIALIZED (
  SELECT a.conv_id * 100000 + a.turn AS pair_id, a.text AS pred, b.text AS ref
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""


def cosine(a: str, b: str) -> str:
    return (
        f"list_inner_product({a}, {b}) / "
        f"(sqrt(list_inner_product({a}, {a})) * sqrt(list_inner_product({b}, {b})))"
    )


def mean_vectors(tokens_: str, id: str, source: str, count: str) -> str:
    """Mean of the word vectors of a list column, by dimension."""
    return f"""item AS MATERIALIZED (
  SELECT {id}, t.word, count(*) AS tf FROM (SELECT {id}, unnest({tokens_}) AS word FROM {source}) t GROUP BY ALL),
total AS (SELECT {id}, sum(tf) AS everything FROM item GROUP BY {id}),
known AS (SELECT {id}, sum(tf) AS n FROM item SEMI JOIN lemma_vector USING (word) GROUP BY {id}),
spread AS (
  SELECT {id}, dim, sum(tf * x) AS s FROM (
    SELECT {id}, tf, generate_subscripts(v, 1) AS dim, unnest(v) AS x FROM item JOIN lemma_vector USING (word))
  GROUP BY ALL),
mean AS (
  SELECT {id}, list(s / {count} ORDER BY dim) AS v
  FROM spread JOIN known USING ({id}) JOIN total USING ({id}) GROUP BY {id})
SELECT i.{id}, round(coalesce(list_sum(v), 0.0), 6) AS v_sum,
  round(coalesce(list_sum(list_transform(v, lambda x, i: x * i)), 0.0), 6) AS v_pos
FROM {source} i LEFT JOIN mean USING ({id})"""


TOKEN_ROWS = """token AS (
  SELECT label AS doc_id, vec_id AS pos, generate_subscripts(embedding, 1) - 1 AS dim,
    unnest(embedding)::DOUBLE AS x, embedding[1] >= 0 AS mask FROM embeddings)"""


def nearest_vectors(source: str, id: str, v: str, k: int, label: str = "") -> str:
    return f"""SELECT {label} query_id, rank, item_id, round(s, 6) AS score FROM (
  SELECT query_id, item_id, s, row_number() OVER (
    PARTITION BY query_id ORDER BY round(s, 6) DESC, item_id)::INTEGER AS rank
  FROM (SELECT a.{id} AS query_id, b.{id} AS item_id, {cosine("a.v", "b.v")} AS s
    FROM (SELECT {id}, {v} AS v FROM {source}) a, (SELECT {id}, {v} AS v FROM {source}) b
    WHERE a.{id} <> b.{id})) WHERE rank <= {k}"""


def similar_docs(weights: str, k: int) -> str:
    return f"""norm AS (SELECT doc_id, sqrt(sum(weight * weight)) AS n FROM {weights} GROUP BY doc_id),
pair AS MATERIALIZED (
  SELECT l.doc_id AS query_id, r.doc_id AS item_id, sum(l.weight * r.weight) AS s
  FROM {weights} l JOIN {weights} r ON l.idx = r.idx AND l.doc_id <> r.doc_id GROUP BY ALL),
every AS (
  SELECT a.doc_id AS query_id, b.doc_id AS item_id, coalesce(p.s / (x.n * y.n), 0.0) AS s
  FROM processed a JOIN processed b ON a.doc_id <> b.doc_id
  LEFT JOIN pair p ON p.query_id = a.doc_id AND p.item_id = b.doc_id
  LEFT JOIN norm x ON x.doc_id = a.doc_id LEFT JOIN norm y ON y.doc_id = b.doc_id)
SELECT query_id, rank, item_id, round(s, 6) AS score FROM (
  SELECT *, row_number() OVER (
    PARTITION BY query_id ORDER BY round(s, 6) DESC, item_id)::INTEGER AS rank FROM every)
WHERE rank <= {k}"""


def matrix(kind: str, weights: str) -> str:
    return f"""SELECT '{kind}' AS kind, n AS n_docs, (SELECT count(*) FROM vocab) AS n_terms,
  (SELECT count(*) FROM {weights}) AS nnz, (SELECT sum(weight) FROM {weights}) AS s,
  (SELECT sum(weight * weight) FROM {weights}) AS s2, (SELECT max(weight) FROM {weights}) AS hi FROM size"""


MATRICES = f"""{LEMMA_TFIDF}, m AS ({matrix("bow", "bow")} UNION ALL {matrix("tfidf", "weight")})"""

LABELLED = "labelled AS (SELECT doc_id, quality::VARCHAR AS t, toxic::VARCHAR AS p FROM labels)"
PER_LABEL = f"""{LABELLED},
each AS MATERIALIZED (
  SELECT label, sp, pr, ok,
    coalesce(ok / nullif(pr, 0)::DOUBLE, 0.0) AS precision, coalesce(ok / nullif(sp, 0)::DOUBLE, 0.0) AS recall,
    coalesce(2.0 * ok / nullif(sp + pr, 0), 0.0)::DOUBLE AS f1
  FROM (SELECT label,
      (SELECT count(*) FROM labelled WHERE t = label) AS sp,
      (SELECT count(*) FROM labelled WHERE p = label) AS pr,
      (SELECT count(*) FROM labelled WHERE t = label AND p = label) AS ok
    FROM (SELECT t AS label FROM labelled UNION SELECT p FROM labelled)))"""


def answer(text: str, known: list[str]) -> str:
    raw = f"lower({strip(text)})"
    first = f"regexp_replace({words(raw)}[1], '[.,;:!?''\"]+$', '')"
    listed = ", ".join(quote(k) for k in known)
    found = " ".join(f"WHEN contains({raw}, {quote(k)}) THEN {quote(k)}" for k in known)
    return f"""CASE WHEN {raw} = '' THEN 'other' WHEN {first} IN ({listed}) THEN {first}
    {found} ELSE 'other' END"""


def summary_pass(units: str, keys: str, limit: int, out: str) -> str:
    """CTE chain that picks the best sentences of each unit in text order."""
    on = " AND ".join(f"a.{k.strip()} = b.{k.strip()}" for k in keys.split(","))
    return f"""{out}_s AS MATERIALIZED (
  SELECT {keys}, generate_subscripts(l, 1) AS pos, unnest(l) AS sentence FROM (
    SELECT {keys}, {sentence_list("text")} AS l FROM {units})),
{out}_t AS (
  SELECT {keys}, pos, sum(ln((1 + n) / (1.0 + df)::DOUBLE) + 1) AS total
  FROM (SELECT {keys}, pos, unnest({terms("sentence")}) AS term FROM {out}_s) JOIN vocab USING (term), size
  GROUP BY ALL),
{out}_n AS (
  SELECT a.*, len({words("a.sentence")}) AS n, coalesce(b.total, 0.0) / len({words("a.sentence")}) AS score
  FROM {out}_s a LEFT JOIN {out}_t b ON {on} AND a.pos = b.pos),
{out}_r AS (
  SELECT *, row_number() OVER best AS rank, sum(n) OVER (
    PARTITION BY {keys} ORDER BY round(score, 6) DESC, pos ROWS UNBOUNDED PRECEDING) AS upto
  FROM {out}_n WINDOW best AS (PARTITION BY {keys} ORDER BY round(score, 6) DESC, pos)),
{out}_p AS (
  SELECT {keys}, string_agg(sentence, ' ' ORDER BY pos) AS text FROM {out}_r
  WHERE rank = 1 OR upto <= {limit} GROUP BY {keys}),
{out} AS MATERIALIZED (
  SELECT u.*, coalesce(array_to_string({words("p.text")}[1:{limit}], ' '), '') AS summary
  FROM {units} u LEFT JOIN {out}_p p USING ({keys}))"""


DOC_TERMS = f"""doc_terms AS MATERIALIZED (SELECT doc_id, {terms("text")} AS g FROM documents),
{sparse_sql("doc_terms", "doc_id", "g", 1, 1.0, 1_000_000_000)}"""


def prompt_sql() -> str:
    lines = "\n".join(f"- {k}: {v}" for k, v in INTENTS.items())
    question = f"replace({strip('c.text')}, '\"', '''')"
    parts = quote(PROMPT_TEMPLATE).replace("{intent_descriptions}", lines.replace("'", "''"))
    parts = parts.replace("{question}", f"' || {question} || '")
    return parts.replace("{examples}", "' || e.x || '")


def principal(source: str) -> str:
    """Mean, first two principal axes and their variances of weighted vectors (id, v, w).

    The axis is what powers of the covariance tend to: the matrix is squared until the 2^24th.
    """

    def axis(matrix: str, name: str) -> list[str]:
        out = [f"{name}_0 AS MATERIALIZED (SELECT i, j, s / (SELECT sum(s) FROM {matrix} WHERE i = j) AS s FROM {matrix})"]
        for n in range(24):
            square = f"SELECT a.i, b.j, sum(a.s * b.s) AS s FROM {name}_{n} a JOIN {name}_{n} b ON a.j = b.i GROUP BY ALL"
            out.append(
                f"{name}_{n}s AS MATERIALIZED ({square}), {name}_{n + 1} AS MATERIALIZED ("
                f"SELECT i, j, s / (SELECT sum(s) FROM {name}_{n}s WHERE i = j) AS s FROM {name}_{n}s)"
            )
        last = f"{name}_24"
        column = f"SELECT i, s FROM {last} WHERE j = (SELECT arg_max(i, s) FROM {last} WHERE i = j)"
        scale = "sqrt(sum(s * s) OVER ()) * sign(arg_max(s, abs(s)) OVER ())"
        out.append(f"{name} AS MATERIALIZED (SELECT i, s / ({scale}) AS x FROM ({column}))")
        value = f"SELECT sum(a.x * s * b.x) AS v FROM {matrix} JOIN {name} a USING (i) JOIN {name} b ON b.i = j"
        out.append(f"{name}_v AS MATERIALIZED ({value})")
        return out

    base = f"""src AS MATERIALIZED ({source}),
flat AS MATERIALIZED (SELECT id, w, generate_subscripts(v, 1) AS i, unnest(v)::DOUBLE AS x FROM src),
centre AS MATERIALIZED (SELECT i, sum(w * x) / sum(w) AS m FROM flat GROUP BY i),
c AS MATERIALIZED (SELECT id, w, i, x - m AS x FROM flat JOIN centre USING (i)),
cov AS MATERIALIZED (SELECT a.i, b.i AS j, sum(a.w * a.x * b.x) AS s FROM c a JOIN c b USING (id) GROUP BY ALL)"""
    rest = "cov2 AS MATERIALIZED (SELECT cov.i, j, s - (SELECT v FROM p_v) * a.x * b.x AS s FROM cov JOIN p a USING (i) JOIN p b ON b.i = j)"
    placed = """placed AS MATERIALIZED (SELECT id, sum(c.x * p.x) AS x, sum(c.x * q.x) AS y FROM c JOIN p USING (i) JOIN q USING (i) GROUP BY id),
share AS (SELECT ((SELECT v FROM p_v) + (SELECT v FROM q_v)) / (SELECT sum(s) FROM cov WHERE i = j) AS explained)"""
    return ",\n".join([base, *axis("cov", "p"), rest, *axis("cov2", "q"), placed])


def rouge_tokens(c: str) -> str:
    toks = f"list_filter(string_split_regex(lower({c}), '[^a-z0-9]+'), lambda w: w <> '')"
    return f"list_transform({toks}, lambda w: CASE WHEN length(w) > 3 THEN {stem('w')} ELSE w END)"


def lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence: row by row, the running best of hits and of the row above."""
    hits = f"list_transform({b}, lambda y: list_transform({a}, lambda x: (x = y)::BIGINT))"
    cell = "CASE WHEN h = 1 THEN 1 + CASE WHEN i > 1 THEN row[i - 1] ELSE 0 END ELSE row[i] END"
    step = f"list_transform(row, lambda v, j: list_max(list_transform(hit[1:j], lambda h, i: {cell})))"
    rows = f"list_concat([list_transform({a}, lambda x: 0::BIGINT)], {hits})"
    return f"list_max(list_concat([0], list_reduce({rows}, lambda row, hit: {step})))"


def rouge(n: int) -> str:
    def side(c):
        toks = rouge_tokens(c)
        if n == 1:
            return toks
        return f"(SELECT list_transform(range(1, len(l)), lambda i: l[i] || ' ' || l[i + 1]) FROM (SELECT {toks} AS l))"

    return f"""g{n} AS MATERIALIZED (
  SELECT pair_id, g, sum(a) AS cp, sum(b) AS cr FROM (
    SELECT pair_id, unnest({side("pred")}) AS g, 1 AS a, 0 AS b FROM pairs
    UNION ALL SELECT pair_id, unnest({side("ref")}), 0, 1 FROM pairs) GROUP BY ALL),
f{n} AS (
  SELECT pair_id, 2.0 * sum(least(cp, cr)) / (sum(cp) + sum(cr)) AS f FROM g{n} GROUP BY pair_id)"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # A, B
    page = "html"
    for pattern in (
        r"(?s)<!--.*?-->",
        r"(?is)<script[^>]*>.*?</script>",
        r"(?is)<style[^>]*>.*?</style>",
        r"(?s)<[^>]*>",
    ):
        page = replace_all(page, pattern, " ")
    for entity, char in (
        ("&nbsp;", " "),
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "'"),
        ("&amp;", "&"),
    ):
        page = f"replace({page}, {quote(entity)}, {quote(char)})"
    sql["a2_page_text"] = f"""SELECT * FROM (
  SELECT page_id, url AS filename, {strip(squeeze(page))} AS raw_text FROM pages) WHERE raw_text <> ''"""
    sql["a3_load_processed"] = f"""WITH {ANALYZED}
SELECT doc_id, filename, array_to_string(lemmas, ' ') AS lemmas, len(tokens)::INTEGER AS num_tokens FROM processed"""
    sql["a6_vocabularies"] = f"""WITH {ANALYZED},
{sparse_sql("processed", "doc_id", "lemmas", 2, 0.8, 2000, "_b")},
{sparse_sql("processed", "doc_id", "lemmas", 2, 0.8, 1000, "_t")}
SELECT 'bow' AS kind, term, idx FROM vocab_b UNION ALL SELECT 'tfidf', term, idx FROM vocab_t"""
    sql["b1_clean"] = f"WITH {CLEANED} SELECT doc_id, clean_text FROM cleaned"
    for name, column in (
        ("b2_tokenize", "tokens_original"),
        ("b3_fold_case", "tokens_lower"),
        ("b4_alnum", "tokens_alnum"),
        ("b5_stop_words", "tokens"),
    ):
        sql[name] = f"WITH {ANALYZED} SELECT doc_id, array_to_string({column}, ' ') AS tokens FROM analyzed"
    sql["b6_stem"] = (
        f"WITH {ANALYZED} SELECT doc_id, array_to_string(tokens_stemmed, ' ') AS tokens_stemmed FROM analyzed"
    )
    sql["b7_lemmatize"] = f"""WITH {ANALYZED},
form AS (SELECT DISTINCT unnest(tokens) AS form FROM processed),
lexicon AS (SELECT form, {stem("form")} AS lemma FROM form),
attested AS (SELECT l.form, l.lemma FROM lexicon l SEMI JOIN form f ON f.form = l.lemma),
item AS (SELECT doc_id, generate_subscripts(tokens, 1) AS pos, unnest(tokens) AS form FROM processed),
looked AS (SELECT doc_id, pos, coalesce(lemma, form) AS lemma FROM item LEFT JOIN attested USING (form))
SELECT doc_id, string_agg(lemma, ' ' ORDER BY pos) AS lemmas FROM looked
WHERE NOT list_contains({STOPS}, lemma) GROUP BY doc_id"""
    sql["b8_sentences"] = f"""WITH {ANALYZED}
SELECT doc_id, (generate_subscripts(sentences, 1) - 1)::INTEGER AS pos, unnest(sentences) AS sentence FROM analyzed"""
    sql["b9_analyze"] = f"""WITH {ANALYZED}
SELECT doc_id, filename, clean_text, array_to_string(tokens, ' ') AS tokens,
  array_to_string(tokens_stemmed, ' ') AS tokens_stemmed, array_to_string(lemmas, ' ') AS lemmas,
  array_to_string(sentences, chr(10)) AS sentences, len(tokens)::INTEGER AS num_tokens,
  len(sentences)::INTEGER AS num_sentences FROM analyzed"""
    sql["b10_corpus"] = f"""WITH {ANALYZED}
SELECT doc_id, filename, raw_text, clean_text, len(tokens)::INTEGER AS num_tokens,
  len(sentences)::INTEGER AS num_sentences FROM processed"""
    sql["b11_corpus_stats"] = f"""WITH {ANALYZED}
SELECT count(*) AS total_documents, sum(len(tokens))::BIGINT AS total_tokens,
  sum(len(sentences))::BIGINT AS total_sentences,
  (SELECT count(DISTINCT t) FROM (SELECT unnest(tokens) AS t FROM processed)) AS unique_tokens,
  round(avg(len(tokens)), 6) AS avg_doc_length FROM processed"""
    sql["b12_length_histogram"] = f"""WITH {ANALYZED},
l AS (SELECT len(tokens)::DOUBLE AS v FROM processed),
b AS (SELECT min(v) AS lo, max(v) AS hi, avg(v) AS mean FROM l),
c AS (SELECT least(floor((v - lo) * 25 / (hi - lo)) + 1, 25)::BIGINT AS bin, count(*) AS n FROM l, b GROUP BY 1)
SELECT i.bin, round(lo + (i.bin - 1) * (hi - lo) / 25, 6) AS low, round(lo + i.bin * (hi - lo) / 25, 6) AS high,
  coalesce(c.n, 0) AS n, round(mean, 6) AS mean
FROM (SELECT unnest(range(1, 26)) AS bin) i CROSS JOIN b LEFT JOIN c ON c.bin = i.bin"""
    lemma = "(SELECT unnest(lemmas) AS term FROM processed)"
    sql["b13_top_lemmas"] = f"""WITH {ANALYZED}
SELECT term, count(*) AS freq FROM {lemma} GROUP BY term ORDER BY freq DESC, term LIMIT 15"""
    sql["b14_distinct_lemmas"] = (
        f"WITH {ANALYZED} SELECT count(DISTINCT term) AS n_terms FROM {lemma}"
    )
    sql["b15_corpus_strings"] = (
        f"WITH {ANALYZED} SELECT doc_id, array_to_string(lemmas, ' ') AS corpus FROM processed"
    )

    # C
    sql["c1_vocabulary"] = f"""WITH {ANALYZED},
{sparse_sql("processed", "doc_id", "lemmas", 2, 0.8, 2000)} SELECT term, idx, df, cf FROM vocab"""
    sql["c2_bag_of_words"] = f"WITH {LEMMA_TFIDF} SELECT * FROM bow"
    sql["c4_tfidf"] = (
        f"WITH {LEMMA_TFIDF} SELECT doc_id, term, idx, round(weight, 6) AS weight FROM weight"
    )
    sql["c5_matrix_shape"] = f"""WITH {MATRICES}
SELECT kind, n_docs, n_terms, nnz, round(nnz * 100.0 / (n_docs * n_terms), 6)::DOUBLE AS density_pct FROM m"""
    sql["c6_matrix_moments"] = f"""WITH {MATRICES},
x AS (SELECT *, (n_docs * n_terms)::DOUBLE AS cells FROM m)
SELECT kind, round(nnz * 100 / cells, 6) AS density_pct, round(100 - nnz * 100 / cells, 6) AS sparsity_pct,
  0.0::DOUBLE AS min, round(hi, 6) AS max, round(s / cells, 6) AS mean,
  round(sqrt(s2 / cells - (s / cells) * (s / cells)), 6) AS std FROM x"""
    ranked = """SELECT '{0}' AS kind, term, round(sum(weight), 6) AS score FROM {1} GROUP BY term
  ORDER BY score DESC, term LIMIT {2}"""
    sql["c7_top_terms"] = f"""WITH {LEMMA_TFIDF}
SELECT * FROM ({ranked.format("bow", "bow", 20)}) UNION ALL
SELECT * FROM ({ranked.format("tfidf", "weight", 20)})"""
    sql["c8_similarity_edges"] = f"""WITH {LEMMA_TFIDF},
sig AS (SELECT p.doc_id, coalesce(string_agg(r.idx || ':' || round(r.weight, 6), ' ' ORDER BY r.idx), '') AS sig
  FROM processed p LEFT JOIN weight r ON r.doc_id = p.doc_id GROUP BY p.doc_id),
vertex AS (SELECT sig, min(doc_id) AS doc_id, count(*) AS copies FROM sig GROUP BY sig),
vw AS MATERIALIZED (SELECT w.doc_id, idx, weight, copies FROM weight w JOIN vertex v ON v.doc_id = w.doc_id),
pair AS (
  SELECT l.doc_id AS left_id, r.doc_id AS right_id, sum(l.weight * r.weight) AS c,
    max(l.copies) AS left_copies, max(r.copies) AS right_copies
  FROM vw l JOIN vw r ON l.idx = r.idx AND l.doc_id < r.doc_id GROUP BY l.doc_id, r.doc_id)
SELECT left_id, right_id, round(c, 6) AS cosine, left_copies, right_copies FROM pair WHERE round(c, 6) >= 0.5"""
    sql["c8_copy_groups"] = f"""WITH {LEMMA_TFIDF},
sig AS (SELECT p.doc_id, coalesce(string_agg(r.idx || ':' || round(r.weight, 6), ' ' ORDER BY r.idx), '') AS sig
  FROM processed p LEFT JOIN weight r ON r.doc_id = p.doc_id GROUP BY p.doc_id)
SELECT doc_id, min(doc_id) OVER (PARTITION BY sig) AS group_id, count(*) OVER (PARTITION BY sig) AS copies FROM sig"""
    sql["c9_similar_docs"] = f"WITH {LEMMA_TFIDF}, {similar_docs('weight', 5)}"
    sql["c9_similar_docs_bow"] = f"WITH {LEMMA_TFIDF}, {similar_docs('bow', 3)}"
    side = """(SELECT row_number() OVER (ORDER BY score DESC, term)::INTEGER AS rank, term, score
  FROM (SELECT term, round(sum(weight), 6) AS score FROM {0} GROUP BY term ORDER BY score DESC, term LIMIT 15))"""
    sql["c10_compare_top_terms"] = f"""WITH {LEMMA_TFIDF}
SELECT coalesce(a.rank, b.rank) AS rank, a.term AS bow_term, a.score AS bow_score,
  b.term AS tfidf_term, b.score AS tfidf_score
FROM {side.format("bow")} a FULL OUTER JOIN {side.format("weight")} b ON a.rank = b.rank"""
    sql["c11_retrieval_tfidf"] = (
        f"WITH {INDEX} SELECT chunk_id, term, idx, round(weight, 6) AS weight FROM weight"
    )
    sql["c12_query_vectors"] = (
        f"WITH {INDEX} SELECT query_id, term, idx, round(weight, 6) AS weight FROM query_weight"
    )

    # D
    sql["d1_windows"] = f"""WITH {ANALYZED}
SELECT doc_id, (start // 10)::INTEGER AS pos, array_to_string(lemmas[start + 1 : start + 10], ' ') AS sentence
FROM (SELECT doc_id, lemmas, unnest(range(0, len(lemmas), 10)) AS start FROM processed)
WHERE len(lemmas[start + 1 : start + 10]) > 2"""
    sql["d2_vocabulary"] = f"""WITH {ANALYZED}
SELECT word, count(*) AS n, 100 AS dim FROM (
  SELECT unnest(lemmas[start + 1 : start + 10]) AS word
  FROM (SELECT lemmas, unnest(range(0, len(lemmas), 10)) AS start FROM processed) WHERE len(lemmas[start + 1 : start + 10]) > 2)
GROUP BY word HAVING count(*) >= 2"""
    word = "'<' || {0} || '>'"
    gram = f"""SELECT DISTINCT word, substr(m, i::BIGINT, n::BIGINT) AS gram FROM (
    SELECT word, m, n, unnest(range(1, length(m) - n + 2)) AS i FROM (
      SELECT word, {word.format("word")} AS m, unnest([3, 4, 5, 6]) AS n FROM {{0}}) WHERE length(m) >= n)"""
    sql["d3_subwords"] = f"""WITH {LEMMA_VECTORS},
known_gram AS MATERIALIZED ({gram.format("lemma_vector")}),
own AS MATERIALIZED (SELECT word, list_sum(v) AS v_sum, list_sum(list_transform(v, lambda x, i: x * i)) AS v_pos
  FROM lemma_vector),
gram_sums AS MATERIALIZED (
  SELECT gram, avg(v_sum) AS v_sum, avg(v_pos) AS v_pos FROM known_gram JOIN own USING (word) GROUP BY gram),
unseen AS (SELECT term AS word FROM lemma_count ANTI JOIN lemma_vector ON word = term),
unseen_gram AS MATERIALIZED ({gram.format("unseen")}),
built AS (
  SELECT word, avg(v_sum) AS v_sum, avg(v_pos) AS v_pos FROM unseen_gram JOIN gram_sums USING (gram) GROUP BY word)
SELECT c.term AS word, o.word IS NOT NULL AS trained, round(coalesce(o.v_sum, b.v_sum, 0.0), 6) AS v_sum,
  round(coalesce(o.v_pos, b.v_pos, 0.0), 6) AS v_pos
FROM lemma_count c LEFT JOIN own o ON o.word = c.term LEFT JOIN built b ON b.word = c.term"""
    oov = """SELECT '{0}' AS model, count(*) AS total_words, count(v.word) AS in_vocab,
  count(*) - count(v.word) AS oov_count, round((count(*) - count(v.word)) * 100.0 / count(*), 6)::DOUBLE AS oov_percentage
FROM lemma_count c LEFT JOIN {1} v ON v.word = c.term"""
    sql["d4_oov_report"] = f"""WITH {LEMMA_VECTORS}
SELECT *, (SELECT string_agg(term, ' ' ORDER BY term) FROM (
  SELECT term FROM lemma_count ANTI JOIN lemma_vector ON word = term ORDER BY term LIMIT 50)) AS oov_words
FROM ({oov.format("word2vec", "lemma_vector")})"""
    sql["d5_compare_oov"] = f"""WITH {LEMMA_VECTORS}
{oov.format("word2vec", "lemma_vector")} UNION ALL
{oov.format("fasttext", "(SELECT term AS word FROM lemma_count)")} UNION ALL
{oov.format("glove", "(SELECT word FROM lemma_vector WHERE md5(word) < '8')")}"""
    sql["d6_word_similarity"] = f"""SELECT 'w' || a.vec_id AS word1, 'w' || (a.vec_id + 1) AS word2,
  round({cosine("a.embedding::DOUBLE[]", "b.embedding::DOUBLE[]")}, 6) AS similarity
FROM embeddings a LEFT JOIN embeddings b ON b.vec_id = a.vec_id + 1"""
    sql["d7_similar_words"] = nearest_vectors(
        "(SELECT 'w' || vec_id AS word, embedding FROM embeddings)", "word", "embedding::DOUBLE[]", 10
    )
    sql["d8_doc_means"] = (
        f"WITH {LEMMA_VECTORS}, {mean_vectors('lemmas', 'doc_id', 'processed', 'n')}"
    )
    drawn = "SELECT vec_id AS id, any_value(v) AS v, count(*)::DOUBLE AS w FROM lemma_vector JOIN lemma_slot USING (word) GROUP BY vec_id"
    slots = f"""lemma_slot AS MATERIALIZED (SELECT term AS word, {bucket("term", "(SELECT count(*) FROM embeddings)")} AS vec_id
  FROM lemma_count WHERE freq >= 2)"""
    sql["d10_pca"] = f"""WITH {LEMMA_VECTORS}, {slots}, {principal(drawn)}
SELECT word, round(x, 6) AS x, round(y, 6) AS y FROM lemma_slot JOIN placed ON id = vec_id"""
    sql["e10_projection"] = f"""WITH {principal("SELECT vec_id AS id, embedding AS v, 1.0::DOUBLE AS w FROM embeddings")}
SELECT vec_id, round(x, 6) AS x, round(y, 6) AS y, round(explained, 6) AS explained, label AS category
FROM placed JOIN embeddings ON vec_id = id, share"""
    sql["e11_color_points"] = f"""SELECT e.*, color FROM ({sql["e10_projection"]}) e JOIN (
  SELECT label, (row_number() OVER (ORDER BY min(vec_id)) - 1)::INTEGER AS color FROM embeddings GROUP BY label) ON label = category"""
    sql["d9_select_words"] = f"""WITH {LEMMA_VECTORS}
SELECT word, freq, {digest("v")} FROM (
  SELECT word, freq, v FROM lemma_vector JOIN lemma_count ON term = word ORDER BY freq DESC, word LIMIT 50)"""

    # E
    sql["e1_encode"] = f"""WITH {hashed_sql("documents", "doc_id", "text", "")}
SELECT doc_id, {digest("v")} FROM vec"""
    sql["e2_truncate"] = (
        f"SELECT doc_id, array_to_string({terms('text')}[1:512], ' ') AS tokens FROM documents"
    )
    sql["e3_cls_pool"] = f"""WITH {TOKEN_ROWS}
SELECT doc_id, dim::INTEGER AS dim, round(arg_min(x, pos), 6) AS value FROM token GROUP BY doc_id, dim"""
    sql["e4_mean_pool"] = f"""WITH {TOKEN_ROWS}
SELECT doc_id, dim::INTEGER AS dim, round(sum(CASE WHEN mask THEN x ELSE 0 END)
  / greatest(sum(CASE WHEN mask THEN 1.0::DOUBLE ELSE 0 END), 1e-9), 6) AS value FROM token GROUP BY doc_id, dim"""
    sql["e5_max_pool"] = f"""WITH {TOKEN_ROWS}
SELECT doc_id, dim::INTEGER AS dim, round(max(CASE WHEN mask THEN x ELSE -1e9 END), 6) AS value
FROM token GROUP BY doc_id, dim"""
    sql["e7_normalize"] = f"""WITH {TOKEN_ROWS},
m AS (SELECT doc_id, dim, avg(x) AS x FROM token GROUP BY doc_id, dim)
SELECT doc_id, dim::INTEGER AS dim, round(x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)), 6) AS value FROM m"""
    sql["e8_similar_by_model"] = (
        nearest_vectors("embeddings", "vec_id", "embedding::DOUBLE[]", 5, "'full' AS model,")
        + " UNION ALL "
        + nearest_vectors("embeddings", "vec_id", "embedding[1:32]::DOUBLE[]", 5, "'half' AS model,")
    )
    stat = """SELECT '{0}' AS model, (SELECT count(*) FROM embeddings) AS n_rows, {1}::INTEGER AS dimensionality,
  round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max,
  round(count(*) FILTER (x = 0) * 100.0 / count(*), 6)::DOUBLE AS sparsity
FROM (SELECT unnest({2})::DOUBLE AS x FROM embeddings)"""
    sql["e9_stats"] = (
        stat.format("full", 64, "embedding") + " UNION ALL " + stat.format("half", 32, "embedding[1:32]")
    )
    sql["e12_filename_index"] = """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, source AS filename,
  count(*) OVER () AS total_documents FROM documents"""

    # F
    sections = chunk_sql(SECTION).replace(" WHERE length(text) >= 20", "")
    sql["f1_tidy"] = f"""SELECT doc_id,
  {strip(replace_all(replace_all("text", r"\n{3,}", chr(10) * 2), " +", " "))} AS text FROM documents"""
    parts = f"""WITH {sections},
s AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY sec) - 1)::INTEGER AS pos, section
  FROM (SELECT doc_id, sec, {strip("body")} AS section FROM section) WHERE section <> '')"""
    sql["f2_sections"] = f"{parts} SELECT * FROM s"
    sql["f3_short_sections"] = f"{parts} SELECT * FROM s WHERE len({words('section')}) < 100"
    windows = f"""WITH w AS (SELECT doc_id, {words("text")} AS w FROM documents),
win AS (
  SELECT doc_id, (start // 350)::INTEGER AS pos, array_to_string(w[start + 1 : start + 400], ' ') AS piece
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w), 1), 350)) AS start FROM w)),
cut AS (
  SELECT doc_id, pos, CASE WHEN brk > 280 AND brk > 20 THEN left(piece, brk + 1) ELSE piece END AS piece
  FROM (SELECT *, greatest(
      CASE WHEN contains(piece, '.') THEN length(piece) - instr(reverse(piece), '.') ELSE -1 END,
      CASE WHEN contains(piece, ':') THEN length(piece) - instr(reverse(piece), ':') ELSE -1 END) AS brk
    FROM win))"""
    sql["f4_windows"] = f"{windows} SELECT * FROM win"
    sql["f5_trim"] = f"{windows} SELECT * FROM cut"
    sql["f6_long_enough"] = f"{windows} SELECT * FROM cut WHERE len({words('piece')}) >= 100"
    sql["f7_chunks"] = f"WITH {sections} SELECT doc_id, chunk_index, chunk_text FROM chunk"
    sql["f9_chunk_table"] = f"WITH {CHUNKS} SELECT * FROM chunks"
    sql["f10_flags"] = f"""WITH {chunk_sql(DEFAULT_STARTS)}
SELECT doc_id, chunk_index, {flags(WARNING, PROCEDURE)} FROM chunk"""
    sql["f14_reassemble"] = f"""WITH {chunk_sql(DEFAULT_STARTS)}
SELECT doc_id, string_agg(chunk_text, chr(10) || chr(10) ORDER BY chunk_index) AS text FROM chunk GROUP BY doc_id"""

    # G
    shown = "query_id, rank, chunk_id, round(score, 6) AS score"
    scope = "filename = 'src7'"
    sql["g1_scoped_search"] = f"""WITH {SCORES}
SELECT query_id, rank, chunk_id, 'src7' AS filename, {quote(SCOPE_ONE.format("src7"))} AS search_scope,
  round(score, 6) AS score FROM {top("lexical", 5, scope)}"""
    sql["g2_dense"] = f"WITH {SCORES} SELECT {shown} FROM {top('dense', 5)}"
    sql["g3_lexical"] = f"WITH {SCORES} SELECT {shown} FROM {top('lexical', 5)}"
    sql["g4_hybrid"] = f"WITH {SCORES} SELECT {shown} FROM {hybrid(5)}"
    boosted = f"""(0.7 * dense + (1 - 0.7) * lexical)
      * (CASE WHEN regexp_matches(k.chunk_text, '(?i){WARNING}') THEN 1.5 ELSE 1.0 END)
      * (CASE WHEN k.has_table THEN 1.2 ELSE 1.0 END)"""
    sql["g5_intent_weights"] = (
        f"WITH {SCORES} SELECT {shown} FROM "
        + hybrid(5, boosted, "JOIN (SELECT chunk_id AS kid, chunk_text, has_table FROM chunks) k ON kid = c.chunk_id")
    )
    sql["g6_results"] = f"""WITH {SCORES}
SELECT h.query_id, h.rank, h.chunk_id, k.filename, left(chunk_text, 150) || '...' AS text_preview,
  chunk_text AS full_text, round(h.score, 6) AS score, {quote(SCOPE_ALL)} AS search_scope,
  is_warning, is_procedure FROM {hybrid(5)} h JOIN chunks k ON k.chunk_id = h.chunk_id"""
    sql["g8_files"] = f"WITH {CHUNKS} SELECT DISTINCT filename FROM chunks"
    counts = """count(*) AS total_chunks, {0} round(avg(length(chunk_text)), 6) AS avg_chunk_length,
  count(*) FILTER (is_warning) AS warnings_detected, count(*) FILTER (is_procedure) AS procedures_detected"""
    sql["g9_chunk_stats"] = f"""WITH {CHUNKS} SELECT {quote(STATS_SCOPE_ALL)} AS scope,
  {counts.format("count(DISTINCT filename) AS unique_files,")} FROM chunks"""
    sql["g9_chunk_stats_by_file"] = (
        f"WITH {CHUNKS} SELECT filename, {counts.format('')} FROM chunks GROUP BY filename"
    )
    sql["g10_compare_methods"] = f"WITH {SCORES}, {methods(5)} SELECT method, {shown} FROM ranked"

    def metrics(miss: str) -> str:
        return f"""WITH {SCORES}, {methods(10)},
rel AS MATERIALIZED (
  SELECT q.query_id, c.chunk_id FROM questions q JOIN chunks c
  ON contains({strip(squeeze("c.chunk_text"))}, {strip(squeeze("q.text"))})),
ideal AS (
  SELECT query_id, sum(1 / log2(i + 1)) AS best FROM (
    SELECT query_id, unnest(range(1, least(n, 10) + 1)) AS i FROM (
      SELECT query_id, count(*) AS n FROM rel GROUP BY query_id)) GROUP BY query_id),
gain AS (
  SELECT method, query_id, min(rank) AS first, sum(1 / log2(rank + 1)) AS dcg
  FROM ranked JOIN rel USING (query_id, chunk_id) GROUP BY ALL),
per AS (
  SELECT m.method, q.query_id, first, coalesce(dcg / best, 0.0) AS ndcg
  FROM questions q CROSS JOIN (SELECT unnest(['sbert', 'tfidf', 'hybrid']) AS method) m
  LEFT JOIN gain g ON g.method = m.method AND g.query_id = q.query_id
  LEFT JOIN ideal i ON i.query_id = q.query_id)
SELECT method, round(avg(coalesce(1.0::DOUBLE / first, {miss})), 6) AS mrr,
  round(avg(CASE WHEN first <= 1 THEN 1.0::DOUBLE ELSE 0 END), 6) AS hit_1,
  round(avg(CASE WHEN first <= 5 THEN 1.0::DOUBLE ELSE 0 END), 6) AS hit_5,
  round(avg(CASE WHEN first <= 10 THEN 1.0::DOUBLE ELSE 0 END), 6) AS hit_10,
  round(avg(ndcg), 6) AS ndcg, round(coalesce(avg(first), 10.0), 6) AS avg_rank_first_relevant,
  count(*) AS total_queries FROM per GROUP BY method"""

    sql["g12_retrieval_metrics"] = metrics("0.0")
    sql["g12_retrieval_metrics_miss"] = metrics("1.0::DOUBLE / 11")

    # H
    sql["h1_split_positional"] = """SELECT vec_id, label, pos,
  CASE WHEN pos < floor(0.1 * n) THEN 'examples' ELSE 'evaluation' END AS part
FROM (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS pos, count(*) OVER () AS n FROM embeddings)"""
    sql["h2_split_stratified"] = """SELECT vec_id, label, rank <= round(0.2 * n) AS is_validation FROM (
  SELECT vec_id, label, count(*) OVER (PARTITION BY label) AS n, row_number() OVER (
    PARTITION BY label ORDER BY md5(vec_id || '#42'), vec_id) AS rank FROM embeddings)"""
    sql["h3_encode_labels"] = """SELECT role, conv_id, turn,
  (dense_rank() OVER (ORDER BY role) - 1)::INTEGER AS label_index FROM conversations"""
    sentence = f"sent AS (SELECT conv_id * 100000 + turn AS doc_id, {terms('text')} AS w FROM conversations)"
    sql["h4_sentence_vectors"] = (
        f"WITH {LEMMA_VECTORS}, {sentence}, {mean_vectors('w', 'doc_id', 'sent', 'everything')}"
    )
    sql["h7_nearest_centroid"] = f"""WITH flat AS (
  SELECT label, generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings),
c AS (SELECT label::VARCHAR AS label, list(m ORDER BY dim) AS v FROM (
  SELECT label, dim, avg(x) AS m FROM flat GROUP BY ALL) GROUP BY label),
s AS (SELECT vec_id, c.label, round({cosine("embedding::DOUBLE[]", "c.v")}, 6) AS s FROM embeddings, c),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label) AS rank FROM s)
SELECT vec_id, CASE WHEN s < 0.3 THEN 'other' ELSE label END AS predicted, s AS score FROM r WHERE rank = 1"""
    sql["h7_nearest_examples"] = f"""WITH near AS (
  {nearest_vectors("embeddings", "vec_id", "embedding::DOUBLE[]", 5).replace("round(s, 6) AS score", "s AS score")}),
votes AS (
  SELECT query_id, label::VARCHAR AS label, count(*) AS votes, round(sum(score), 6) AS total, max(score) AS top
  FROM near JOIN embeddings ON vec_id = item_id GROUP BY ALL),
r AS (SELECT *, max(top) OVER (PARTITION BY query_id) AS best, row_number() OVER (
  PARTITION BY query_id ORDER BY votes DESC, total DESC, label) AS rank FROM votes)
SELECT query_id AS vec_id, label AS predicted, votes, round(best, 6) AS score FROM r WHERE rank = 1"""
    hit = "avg(CASE WHEN t = p THEN 1.0::DOUBLE ELSE 0 END)"
    sql["h8_accuracy"] = f"WITH {LABELLED} SELECT round({hit}, 6) AS accuracy FROM labelled"
    sql["h9_macro_f1"] = f"""WITH {PER_LABEL}
SELECT 'union' AS labels, round(avg(f1), 6) AS f1_macro FROM each
UNION ALL SELECT 'true', round(avg(f1), 6) FROM each WHERE sp > 0"""
    sql["h10_report"] = f"""WITH {PER_LABEL}
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  sp::BIGINT AS support FROM each
UNION ALL SELECT 'accuracy', NULL, NULL, round({hit}, 6), count(*) FROM labelled
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
  sum(sp)::BIGINT FROM each
UNION ALL SELECT 'weighted avg', round(sum(precision * sp) / sum(sp), 6), round(sum(recall * sp) / sum(sp), 6),
  round(sum(f1 * sp) / sum(sp), 6), sum(sp)::BIGINT FROM each"""
    sql["h11_confusion"] = f"""WITH {LABELLED}, l AS (SELECT DISTINCT t AS label FROM labelled)
SELECT a.label AS true, b.label AS pred,
  (SELECT count(*) FROM labelled WHERE t = a.label AND p = b.label) AS n FROM l a CROSS JOIN l b"""
    sql["h12_prediction_table"] = f"""WITH {LABELLED}
SELECT text AS question, t AS true_intent, p AS predicted_intent, t = p AS is_correct
FROM labelled JOIN documents USING (doc_id)"""
    sql["h13_normalize_answers"] = (
        f"SELECT conv_id, turn, {answer('text', TAXONOMY)} AS intent FROM conversations"
    )
    sql["h14_prompts"] = f"""WITH first AS (
  SELECT role, arg_min(text, (conv_id, turn)) AS text FROM conversations GROUP BY role),
e AS (SELECT string_agg(text, ' | ' ORDER BY role) AS x FROM first)
SELECT c.conv_id, c.turn, {prompt_sql()} AS prompt FROM conversations c, e"""
    sql["h15_evaluate_answers"] = f"""WITH r AS MATERIALIZED (
  SELECT role AS model, {answer("text", TAXONOMY[2:])} AS t,
    CASE WHEN contains(text, '?') THEN 'other' ELSE {answer("text", TAXONOMY)} END AS p,
    CASE WHEN contains(text, '?') THEN 0.0 ELSE length(text) END::DOUBLE AS ms FROM conversations),
l AS (SELECT DISTINCT model, t AS label FROM r),
f AS (SELECT model, label, 2.0::DOUBLE * count(*) FILTER (r.t = label AND r.p = label)
    / (count(*) FILTER (r.t = label) + count(*) FILTER (r.p = label)) AS f1
  FROM l JOIN r USING (model) GROUP BY model, label),
a AS (SELECT model, {hit} AS acc, avg(ms) AS ms, count(*) AS n FROM r GROUP BY model)
SELECT model, round(acc, 6) AS accuracy, round(f1, 6) AS f1_macro, round(ms, 6) AS avg_inference_time_ms,
  n AS test_set_size FROM a JOIN (SELECT model, avg(f1) AS f1 FROM f GROUP BY model) USING (model)"""

    # I
    sql["i1_summarize_single"] = f"""WITH {DOC_TERMS},
unit AS (SELECT doc_id, text FROM documents),
{summary_pass("unit", "doc_id", 150, "one")} SELECT doc_id, summary FROM one"""
    chunked = chunk_sql(DEFAULT_STARTS).replace(" WHERE length(text) >= 20", "")
    sql["i2_summarize_hierarchical"] = f"""WITH {DOC_TERMS}, {chunked},
unit AS (SELECT doc_id, chunk_index, chunk_text AS text FROM chunk),
{summary_pass("unit", "doc_id, chunk_index", 150, "one")},
combined AS MATERIALIZED (
  SELECT doc_id, string_agg(summary, chr(10) ORDER BY chunk_index) AS text, count(*) AS parts
  FROM one GROUP BY doc_id),
{summary_pass("combined", "doc_id", 200, "two")}
SELECT d.doc_id, coalesce(CASE WHEN t.parts > 1 THEN t.summary ELSE t.text END, '') AS summary
FROM documents d LEFT JOIN two t ON t.doc_id = d.doc_id"""
    sql["i4_rouge_n"] = f"""WITH {PAIRS}, {rouge(1)}, {rouge(2)}
SELECT p.pair_id, round(coalesce(f1.f, 0.0), 6)::DOUBLE AS rouge_1, round(coalesce(f2.f, 0.0), 6)::DOUBLE AS rouge_2
FROM pairs p LEFT JOIN f1 ON f1.pair_id = p.pair_id LEFT JOIN f2 ON f2.pair_id = p.pair_id"""
    sql["i5_rouge_l"] = f"""WITH {PAIRS},
t AS (SELECT pair_id, {rouge_tokens("pred")} AS a, {rouge_tokens("ref")} AS b FROM pairs)
SELECT pair_id, round(coalesce(2.0 * {lcs("a", "b")} / nullif(len(a) + len(b), 0), 0.0), 6)::DOUBLE AS rouge_l FROM t"""
    sql["i6_greedy_match"] = f"""WITH {LEMMA_VECTORS}, {PAIRS},
unit AS (SELECT word, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS v FROM lemma_vector),
tp AS MATERIALIZED (
  SELECT pair_id, pos, v FROM (SELECT pair_id, generate_subscripts(l, 1) AS pos, unnest(l) AS word
    FROM (SELECT pair_id, {terms("pred")} AS l FROM pairs)) JOIN unit USING (word)),
tr AS MATERIALIZED (
  SELECT pair_id, pos, v FROM (SELECT pair_id, generate_subscripts(l, 1) AS pos, unnest(l) AS word
    FROM (SELECT pair_id, {terms("ref")} AS l FROM pairs)) JOIN unit USING (word)),
s AS MATERIALIZED (
  SELECT a.pair_id, a.pos AS i, b.pos AS j, list_inner_product(a.v, b.v) AS s
  FROM tp a JOIN tr b ON a.pair_id = b.pair_id),
pr AS (SELECT pair_id, avg(m) AS x FROM (SELECT pair_id, i, max(s) AS m FROM s GROUP BY ALL) GROUP BY pair_id),
re AS (SELECT pair_id, avg(m) AS x FROM (SELECT pair_id, j, max(s) AS m FROM s GROUP BY ALL) GROUP BY pair_id)
SELECT p.pair_id, round(coalesce(pr.x, 0.0), 6) AS precision, round(coalesce(re.x, 0.0), 6) AS recall,
  round(coalesce(2 * pr.x * re.x / (pr.x + re.x), 0.0), 6) AS f1
FROM pairs p LEFT JOIN pr ON pr.pair_id = p.pair_id LEFT JOIN re ON re.pair_id = p.pair_id"""
    exact = {k: re.sub(r"round\((.*?), 6\)", r"(\1)", sql[k]) for k in ("i4_rouge_n", "i5_rouge_l", "i6_greedy_match")}
    sql["i7_evaluate"] = f"""SELECT round(avg(rouge_1), 6) AS rouge_1, round(avg(rouge_2), 6) AS rouge_2,
  round(avg(rouge_l), 6) AS rouge_l, round(avg(f1), 6) AS match_f1
FROM ({exact["i4_rouge_n"]}) JOIN ({exact["i5_rouge_l"]}) USING (pair_id) JOIN ({exact["i6_greedy_match"]}) USING (pair_id)"""
    # Written and read again.
    sql["a4_save_load"] = f"""WITH f9 AS ({sql["f9_chunk_table"]})
SELECT chunk_id, doc_id, chunk_index, num_words FROM f9"""
    sql["a5_statistics_json"] = sql["b11_corpus_stats"]
    sql["a7_matrix_round_trip"] = """SELECT vec_id, generate_subscripts(embedding, 1)::INTEGER - 1 AS dim,
  unnest(embedding)::DOUBLE AS x FROM embeddings"""
    sql["a8_labelled_json"] = """SELECT text, role AS label, count(*) AS n FROM conversations GROUP BY ALL"""
    sql["a9_predictions_csv"] = """SELECT 'q "' || doc_id || '", x' AS question, quality::VARCHAR AS true_intent,
  toxic::VARCHAR AS predicted_intent, quality = toxic AS is_correct FROM labels"""
    sql["a10_word_vectors"] = """SELECT 'w' || vec_id AS word, round(sum(x), 6) AS v_sum, round(sum(x * dim), 6) AS v_pos
FROM (SELECT vec_id, generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings)
GROUP BY vec_id"""
    sql["c8_similarity_edges_index"] = sql["c8_similarity_edges"].replace(">= 0.5", ">= 0.8")
    sql["g3_lexical_postings"] = sql["g3_lexical"]
    # The same results by the grid that a cluster uses.
    for name in ("c8_similarity_edges", "c9_similar_docs", "d7_similar_words", "e8_similar_by_model", "h7_nearest_examples"):
        sql[f"{name}_grid"] = sql[name]
    for name in ("d7_similar_words", "e8_similar_by_model", "h7_nearest_examples", "g2_dense"):
        sql[f"{name}_cells"] = sql[name]
    sql["c9_similar_docs_postings"] = sql["c9_similar_docs"]
    return sql
