"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

from docklens.llm.quality import BOILERPLATE, Rules
from docklens.llm.queries import RULES
from docklens.llm.reputation import GENERAL, Prior

_WORD = r"[^\x20\x09-\x0D]+"


def _components(vertices: str, edges: str) -> str:
    """CTEs: ``component`` (id, component_id) of the tables vertices(id), edges(a, b)."""
    return f"""
    sides AS (SELECT a, b FROM {edges} UNION ALL SELECT b, a FROM {edges}),
    reach AS (
        SELECT id, id AS to_id FROM {vertices}
        UNION
        SELECT r.id, e.b FROM reach r JOIN sides e ON e.a = r.to_id
    ),
    component AS (SELECT id, min(to_id) AS component_id FROM reach GROUP BY id)"""


_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

NEAR = rf"""
WITH RECURSIVE
    words AS (
        SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents
    ),
    shingles AS (
        SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN [w[1]] ELSE [w[i], w[i + 1]] END AS s
        FROM words, unnest(range(1, greatest(len(w), 2))) AS t(i)
        WHERE len(w) > 0
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
        FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id
        GROUP BY x.doc_id, y.doc_id
    ),
    edges AS (
        SELECT a, b FROM shared s
        JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
        WHERE 100 * s.n >= 80 * (p.n + q.n - s.n)
    ),
    vertices AS (SELECT DISTINCT doc_id AS id FROM documents),
    {_components("vertices", "edges")}
SELECT id AS doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id,
       component_id = id AS kept
FROM component LEFT JOIN sizes ON doc_id = id
"""

VECTORS = f"""
WITH RECURSIVE
    able AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ),
    edges AS (
        SELECT x.vec_id AS a, y.vec_id AS b FROM able x JOIN able y
        ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.v) = len(y.v)
        WHERE list_cosine_similarity(x.v, y.v) >= 0.98
    ),
    vertices AS (SELECT vec_id AS id FROM embeddings),
    {_components("vertices", "edges")},
    degrees AS (SELECT a AS id, count(*) AS n FROM sides GROUP BY a)
SELECT c.id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, component_id = c.id AS kept
FROM component c LEFT JOIN degrees d ON d.id = c.id
"""


def _quality(rules: Rules = Rules()) -> str:
    phrases = " OR ".join(f"contains(low, '{p}')" for p in BOILERPLATE)
    return rf"""
WITH
    docs AS (
        SELECT doc_id, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
    ),
    windows AS (
        SELECT doc_id, i, list_slice(w, i, i + 7) AS s
        FROM docs, unnest(range(1, greatest(len(w) - 6, 1))) AS u(i) WHERE len(w) >= 8
    ),
    again AS (SELECT doc_id, s FROM windows GROUP BY doc_id, s HAVING count(*) > 1),
    covered AS (
        SELECT doc_id, count(DISTINCT i + k) AS n_repeat
        FROM windows JOIN again USING (doc_id, s), unnest(range(0, 8)) AS u(k) GROUP BY doc_id
    ),
    lines AS (
        SELECT doc_id, k, l, regexp_extract_all(l, '{_WORD}') AS w FROM (
            SELECT doc_id, unnest(string_split(t, chr(10))) AS l,
                   generate_subscripts(string_split(t, chr(10)), 1) AS k FROM docs
        )
    ),
    facts AS (
        SELECT doc_id, k, len(w) AS n, l,
               row_number() OVER (PARTITION BY doc_id, l ORDER BY k) > 1 AS copy,
               length(regexp_replace(l, '[^#*$%&|<>]', '', 'g')) AS symbols,
               length(regexp_replace(l, '[^|>]', '', 'g')) AS menu,
               length(regexp_replace(l, '[^A-Z]', '', 'g')) AS capitals,
               length(regexp_replace(l, '[^A-Za-z]', '', 'g')) AS letters,
               len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS stutter,
               regexp_matches(l, '[.!?;:"。！？।؟]') AS marked,
               translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
        FROM lines WHERE len(w) > 0
    ),
    runs AS (
        SELECT *, n >= {rules.min_sentence_words} AND NOT marked
                  AND strlen(l) >= {rules.min_wrapped_bytes} AS goes_on,
               k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS paragraph
        FROM facts
    ),
    stops AS (
        SELECT *, min(CASE WHEN NOT goes_on THEN k END) OVER (
            PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING
        ) AS stop FROM runs
    ),
    verdicts AS (
        SELECT doc_id, n, copy, (
            copy
            OR n >= {rules.min_sentence_words} AND NOT marked
               AND NOT (goes_on AND coalesce(last_marked AND last_paragraph = paragraph, false))
            OR symbols > {rules.max_symbols} * n
            OR menu >= {rules.min_separators} AND menu > {rules.max_separators} * n
            OR letters >= {rules.min_letters} AND capitals > {rules.max_capitals} * letters
            OR n >= {rules.min_stutter_words} AND stutter > {rules.max_stutter} * n
            OR n <= {rules.max_boilerplate_words} AND ({phrases})
        ) AS bad
        FROM stops LEFT JOIN (
            SELECT doc_id, k AS stop, marked AS last_marked, paragraph AS last_paragraph FROM runs
        ) USING (doc_id, stop)
    ),
    sums AS (
        SELECT doc_id, count(*) FILTER (copy) AS n_dup_lines, count(*) FILTER (bad) AS removed,
               coalesce(sum(n) FILTER (bad), 0) AS lost
        FROM verdicts GROUP BY doc_id
    ),
    joined AS (
        SELECT d.doc_id, len(w)::BIGINT AS n_words,
               length(array_to_string(w, ''))::BIGINT AS word_chars,
               length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
               coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
               coalesce(n_repeat, 0)::BIGINT AS n_repeat_words,
               coalesce(removed, 0)::BIGINT AS n_lines_removed,
               coalesce(lost, 0)::BIGINT AS words_removed
        FROM docs d LEFT JOIN sums s ON s.doc_id = d.doc_id
        LEFT JOIN covered c ON c.doc_id = d.doc_id
    )
SELECT *, n_words < {rules.min_words}
              OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed,
       NOT (n_words < {rules.min_words}
            OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words)
           AND words_removed <= {rules.max_lost} * n_words AS kept
FROM joined
"""


CHAT = r"""
WITH
    turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
    ),
    marked AS (
        SELECT *, regexp_replace(replace(text, '\', '\b'), '<(/?turn)', '\\l\1', 'g') AS body,
               replace(regexp_replace(replace(role, '\', '\b'), '<(/?turn)', '\\l\1', 'g'),
                       chr(10), '\n') AS head
        FROM turns
    ),
    joined AS (
        SELECT conv_id, count(*)::BIGINT AS n_turns,
               string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
               coalesce(string_agg(text, '' ORDER BY turn, role, text)
                            FILTER (role = 'assistant'), '') AS learned,
               sum(length(head) + length(body) + 15)::BIGINT AS formatted_chars
        FROM marked GROUP BY conv_id
    )
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned)::BIGINT AS loss_chars,
       sha256(learned) AS loss_sha256, formatted_chars
FROM joined
"""


_LOWERED = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: CTE: the table of CRC-32, one step for each byte
_CRC_TABLE = """
    crc_steps AS (
        SELECT i, list_reduce(
            list_prepend(i, range(8)),
            lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
        ) AS v FROM range(256) AS u(i)
    ),
    crc_table AS (SELECT list(v ORDER BY i) AS steps FROM crc_steps)"""


def _crc(text: str) -> str:
    """Unsigned CRC-32 of a text; ``steps`` comes from ``crc_table``."""
    digit = "(strpos('0123456789ABCDEF', substr(hex(encode({text})), 2 * i + {at}, 1)) - 1)"
    byte = f"{digit.format(text=text, at=1)} * 16 + {digit.format(text=text, at=2)}"
    every = f"list_transform(range(strlen({text})), lambda i: {byte})"
    return (
        f"xor(list_reduce(list_prepend(4294967295, {every}), "
        "lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)"
    )


VARIANTS = rf"""
WITH RECURSIVE {_CRC_TABLE},
    runs AS (
        SELECT doc_id, w, count(*) AS n FROM (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), {_LOWERED}), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+'
            )) AS w FROM documents
        ) GROUP BY doc_id, w
    ),
    marked AS (
        SELECT w, n, {_crc("(doc_id || ':' || w)")} AS h FROM runs, crc_table
    ),
    cut AS (
        SELECT CASE WHEN h % 97 = 0
                    THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2)
                    ELSE w END AS word, n
        FROM marked
    ),
    vocabulary AS (
        SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 5
        GROUP BY word HAVING sum(n) >= 3
    ),
    holes AS (
        SELECT word, n, i, left(word, i - 1) AS h, substr(word, i + 1) AS t
        FROM vocabulary, unnest(range(1, length(word) + 1)) AS u(i)
    ),
    near AS (
        SELECT x.word, y.word AS other, y.n FROM holes x JOIN holes y
        ON x.i = y.i AND x.h = y.h AND x.t = y.t AND x.word <> y.word
        UNION SELECT x.word, y.word, y.n FROM holes x JOIN vocabulary y ON y.word = x.h || x.t
        UNION SELECT y.word, x.word, x.n FROM holes x JOIN vocabulary y ON y.word = x.h || x.t
    ),
    best AS (
        SELECT word, count(*) AS n_near, max(n) AS most FROM near GROUP BY word
    ),
    firsts AS (
        SELECT b.word, n_near, most, min(other) AS other
        FROM best b JOIN near x ON x.word = b.word AND x.n = most GROUP BY b.word, n_near, most
    ),
    forms AS (
        SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near,
               CASE WHEN most >= 2 * v.n THEN other END AS form,
               CASE WHEN most >= 2 * v.n THEN most END AS form_n
        FROM vocabulary v LEFT JOIN firsts f ON f.word = v.word
    ),
    way AS (
        SELECT word, word AS last, form AS next FROM forms
        UNION ALL
        SELECT y.word, f.word, f.form FROM way y JOIN forms f ON f.word = y.next
    )
SELECT f.word, f.form, last AS root, n, n_near, form_n::BIGINT AS form_n
FROM forms f JOIN way ON way.word = f.word AND next IS NULL
"""


def _reputation() -> str:
    prior = Prior()
    fits = [
        (r.text.split("/", 1)[0], "/" + r.text.split("/", 1)[1], r.text, r.verdict) for r in RULES
    ]
    rules = ", ".join(str(f) for f in fits)

    def shrunk(name: str, children: str, key: str, above: str) -> str:
        return f"""
    {name}_level AS (SELECT c.*, p.share AS above FROM {children} c JOIN {above} p ON {key}),
    {name}_likeness AS (
        SELECT least(greatest(coalesce(
            sum(pow(k - n * above, 2) - n * above * (1 - above))
                / nullif(sum(n * (n - 1) * above * (1 - above)), 0), {prior.most}
        ), {prior.least}), {prior.most}) AS likeness FROM {name}_level
    ),
    {name} AS (
        SELECT l.*, 1 / likeness - 1 AS strength,
               ((1 / likeness - 1) * above + k) / (1 / likeness - 1 + n) AS share
        FROM {name}_level l, {name}_likeness
    )"""

    return rf"""
WITH
    rules(own, start, text, verdict) AS (VALUES {rules}),
    urls AS (
        SELECT page_id, CASE WHEN strpos(url, '://') > 0
                             THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages
    ),
    parsed AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_LOWERED}) AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM urls
    ),
    labelled AS (
        SELECT host, count(*) AS n, count(*) FILTER (quality = 0 OR toxic = 1) AS k
        FROM parsed JOIN labels ON doc_id = page_id
        WHERE (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY host
    ),
    named AS (
        SELECT DISTINCT host, string_split(
            regexp_replace(host, '^[^@]*@|:[0-9]*$|\.(?::[0-9]*)?$', '', 'g'), '.') AS l
        FROM parsed
    ),
    hosts AS (
        SELECT d.host, coalesce(n, 0)::DOUBLE AS n, coalesce(k, 0)::DOUBLE AS k,
               CASE WHEN digits THEN name WHEN len(l) > width
                    THEN array_to_string(l[len(l) - width :], '.') ELSE name END AS domain,
               CASE WHEN digits THEN '' ELSE array_to_string(l[len(l) - width + 1 :], '.') END AS suffix
        FROM (
            SELECT host, l, array_to_string(l, '.') AS name,
                   regexp_matches(array_to_string(l, '.'), '^[0-9.]*$|[\[\]]') AS digits,
                   CASE WHEN length(l[-1]) = 2 AND len(l) > 2 AND l[-2] IN {GENERAL}
                        THEN 2 ELSE 1 END AS width
            FROM named
        ) d LEFT JOIN labelled c ON c.host = d.host
    ),
    domains_in AS (
        SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY domain, suffix
    ),
    suffixes_in AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains_in GROUP BY suffix),
    whole AS (SELECT (sum(k) + 0.5) / (sum(n) + 1) AS share FROM suffixes_in),
    {shrunk("suffixes", "suffixes_in", "true", "whole").strip()},
    {shrunk("domains", "domains_in", "c.suffix = p.suffix", "suffixes").strip()},
    {shrunk("judged", "hosts", "c.domain = p.domain AND c.suffix = p.suffix", "domains").strip()},
    bounds AS (
        SELECT host, 1 / (1 + exp(-(ln(a / b) - {prior.z} * sqrt(1 / a + 1 / b)))) AS bound FROM (
            SELECT host, strength * above + k AS a, strength * (1 - above) + n - k AS b FROM judged
        )
    ),
    fitting AS (
        SELECT page_id, p.host, path, text, verdict,
               row_number() OVER (PARTITION BY page_id, p.host, path
                                  ORDER BY length(text) DESC, text) AS place
        FROM (SELECT DISTINCT * FROM parsed) p JOIN rules
        ON (p.host = own OR ends_with(p.host, '.' || own)) AND starts_with(path, start)
    )
SELECT p.page_id, p.host, p.path, f.text AS rule,
       coalesce(f.verdict, CASE WHEN bound > {prior.limit} THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed p JOIN bounds b ON b.host = p.host
LEFT JOIN fitting f ON f.page_id = p.page_id AND f.host = p.host AND f.path = p.path AND place = 1
"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


_FIELDS = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))

MERKLE = rf"""
WITH RECURSIVE {_CRC_TABLE},
    docs AS (
        SELECT doc_id, source, row_number() OVER () AS row, sha256({_FIELDS} || {_field("text")}) AS leaf,
               CASE WHEN {_crc("doc_id::VARCHAR")} % 2 = 0
                    THEN sha256({_FIELDS} || {_field("replace(text, chr(10), '')")})
                    ELSE sha256({_FIELDS} || {_field("text")}) END AS found
        FROM documents, crc_table
    ),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS place,
               dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree
        FROM docs
    ),
    nodes AS (
        SELECT 0 AS level, tree, place, leaf AS h, count(*) OVER (PARTITION BY tree) AS size FROM placed
        UNION ALL
        SELECT level + 1, tree, place // 3, sha256(string_agg(h, '' ORDER BY place)), (size + 2) // 3
        FROM nodes WHERE size > 1 GROUP BY level, tree, place // 3, size
    ),
    over AS (
        SELECT 0 AS level, tree - 1 AS place, h, count(*) OVER () AS size FROM nodes WHERE size = 1
        UNION ALL
        SELECT level + 1, place // 3, sha256(string_agg(h, '' ORDER BY place)), (size + 2) // 3
        FROM over WHERE size > 1 GROUP BY level, place // 3, size
    ),
    trees AS (
        SELECT level, tree, place, h, size FROM nodes UNION ALL SELECT level, 0, place, h, size FROM over
    ),
    -- a node and the row's place in its level, up to the root
    walk AS (
        SELECT row, 0 AS step, 0 AS level, tree, place FROM placed
        UNION ALL
        SELECT w.row, step + 1, CASE WHEN n.size > 1 THEN w.level + 1 ELSE 0 END,
               CASE WHEN n.size > 1 THEN w.tree ELSE 0 END,
               CASE WHEN n.size > 1 THEN w.place // 3 ELSE w.tree - 1 END
        FROM walk w JOIN trees n ON n.level = w.level AND n.tree = w.tree AND n.place = w.place
        WHERE n.size > 1 OR w.tree > 0
    ),
    sides AS (
        SELECT w.row, step,
               coalesce(string_agg(n.h, '' ORDER BY n.place) FILTER (n.place < w.place), '') AS l,
               coalesce(string_agg(n.h, '' ORDER BY n.place) FILTER (n.place > w.place), '') AS r
        FROM walk w JOIN trees n
        ON n.level = w.level AND n.tree = w.tree AND n.place // 3 = w.place // 3
        WHERE n.size > 1 GROUP BY w.row, step, w.place
    ),
    paths AS (
        SELECT row, sha256(string_agg(l || r, '' ORDER BY step)) AS proof,
               list([l, r] ORDER BY step) AS path
        FROM sides GROUP BY row
    ),
    roots AS (SELECT tree, h FROM nodes WHERE size = 1),
    folded AS (
        SELECT p.doc_id, p.leaf, s.h AS subroot, (SELECT h FROM over WHERE size = 1) AS root,
               coalesce(proof, sha256('')) AS proof_sha256,
               list_reduce(list_prepend([found, ''], coalesce(path, [])),
                           lambda a, s: [sha256(s[1] || a[1] || s[2]), ''])[1] AS folded_root
        FROM placed p JOIN roots s ON s.tree = p.tree LEFT JOIN paths ON paths.row = p.row
    )
SELECT *, folded_root = root AS verified FROM folded
"""

SQL: dict[str, str] = {
    "op2_superminhash": NEAR,
    "op4_embedding_lsh": VECTORS,
    "op8_quality": _quality(),
    "op10_chat": CHAT,
    "op11_spelling_variants": VARIANTS,
    "op12_host_reputation": _reputation(),
    "op13_merkle_manifest": MERKLE,
}
