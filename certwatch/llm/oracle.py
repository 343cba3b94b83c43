"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from certwatch.llm.licences import RULES, SENTENCES
from certwatch.llm.queries import URL_RULES
from certwatch.llm.spelling import CRC_TABLE

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _low(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{_CAPITALS}', '{_SMALL}')"


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP1 = rf"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_low("text")}, '{_WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_low("text")}, '{_WORD}') AS w FROM benchmark),
windows AS (SELECT item_id, least(13, len(w)) AS m, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS t
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT m FROM windows),
grams AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS t
          FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lengths WHERE len(w) >= m)),
met AS (SELECT DISTINCT doc_id, i, m, item_id FROM grams JOIN windows USING (m, t)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM met) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM met) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""

_ESCAPED = r"regexp_replace({0}, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')"
OP3 = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + {len("<s>[INST]  [/INST]</s>")})::BIGINT AS formatted_chars
FROM t GROUP BY conv_id"""

OP5 = r"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(""" + _low("text") + r""", '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS t
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 0) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id
          JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
          GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(reach.b)::BIGINT AS component_id
FROM w JOIN reach ON reach.a = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id"""


def _op6() -> str:
    known = ", ".join(f"'{s}'" for s in SENTENCES)
    steps, left = [], "s"
    for i, (_, numbers) in enumerate(RULES):
        wanted = ";" + "".join(f"{n};" for n in numbers)
        steps.append(f"contains({left}, '{wanted}') AS r{i}")
        left = f"replace({left}, '{wanted}', ';-;')"
    names = ", ".join(f"CASE WHEN r{i} THEN '{name}' END" for i, (name, _) in enumerate(RULES))
    place = ", ".join(f"list_position([{names}], '{name}')" for name in dict.fromkeys(n for n, _ in RULES))
    found = ", ".join(f"'{n}'" for n in dict.fromkeys(n for n, _ in RULES))
    return rf"""
WITH x AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array({_low("text")}, '[.!?]+(\s+|$)|\n+'),
        lambda t: list_position([{known}], trim(regexp_replace(t, '[^a-z0-9]+', ' ', 'g'))) - 1), lambda k: k >= 0) AS ids FROM documents),
y AS (SELECT *, ';' || array_to_string(list_transform(ids, lambda k: k || ';'), '') AS s FROM x),
z AS (SELECT *, {", ".join(steps)} FROM y)
SELECT doc_id, len(ids)::BIGINT AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
       array_to_string(list_transform(list_sort(list_filter(list_zip([{place}], [{found}]), lambda p: p[1] IS NOT NULL)), lambda p: p[2]), ',') AS licences
FROM z"""


def _op10() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    return rf"""
WITH r AS (SELECT * FROM (VALUES {rules}) AS r(verdict, rule_host, rule_path)),
p AS (SELECT page_id, {_low(r"regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1)")} AS host,
             coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
m AS (SELECT page_id, rule_host || rule_path AS rule, verdict,
             row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host) + length(rule_path) DESC, length(rule_host) DESC) AS k
      FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN m ON m.page_id = p.page_id AND k = 1"""


def _op11() -> str:
    table = "[" + ", ".join(str(x) for x in CRC_TABLE.tolist()) + "]"
    return rf"""
WITH RECURSIVE table_ AS (SELECT {table}::BIGINT[] AS t),
runs AS (SELECT doc_id, run, count(*) AS c FROM (SELECT doc_id, unnest(regexp_extract_all({_low("text")}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
         GROUP BY ALL),
bytes AS (SELECT run, c, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
            lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 | (unicode(x) >> 6), 128 | (unicode(x) & 63)]::BIGINT[] END)) AS b FROM runs),
sums AS (SELECT run, c, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda s, x: xor(s >> 8, t[(xor(s, x) & 255) + 1])), 4294967295::BIGINT) AS h
         FROM bytes, table_),
seen AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, c FROM sums),
words AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM seen WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
holes AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS hole FROM places),
cut AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS shorter FROM places),
inserted AS (SELECT cut.word AS a, cut.n AS a_n, words.word AS b, words.n AS b_n FROM cut JOIN words ON words.word = cut.shorter),
near AS (SELECT x.word AS a, y.word AS b, y.n AS b_n FROM holes x JOIN holes y ON x.hole = y.hole AND x.word <> y.word
         UNION ALL SELECT a, b, b_n FROM inserted UNION ALL SELECT b, a, a_n FROM inserted),
best AS (SELECT a, count(*) AS n_near, min(struct_pack(less := -b_n, near := b)) AS best FROM near GROUP BY a),
forms AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -best.less >= 2 * n THEN best.near END AS form,
            CASE WHEN -best.less >= 2 * n THEN -best.less END::BIGINT AS form_n FROM words LEFT JOIN best ON a = word),
steps AS (SELECT word, word AS at FROM words UNION ALL SELECT steps.word, forms.form FROM steps JOIN forms ON forms.word = steps.at WHERE forms.form IS NOT NULL),
roots AS (SELECT steps.word, steps.at AS root FROM steps JOIN forms ON forms.word = steps.at WHERE forms.form IS NULL)
SELECT forms.word, n, form, form_n, n_near, root FROM forms JOIN roots USING (word)"""


OP12 = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_low("text")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM (
        SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
        FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m))
      GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
cuts AS (SELECT lang, phrase, m, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
                array_to_string(string_split(phrase, ' ')[k + 1:m], ' ') AS rest
         FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1)),
cut AS (SELECT c.lang, c.phrase, c.m, c.a, c.k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
        FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
weakest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, f, m, array_to_string(string_split(phrase, ' ')[i:i + s - 1], ' ') AS inner_
           FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM f WHERE m > 2))),
alone AS (SELECT * FROM weakest w WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = w.lang AND i.inner_ = w.phrase AND 100 * i.f >= 80 * w.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM alone)
SELECT ranked.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000"""


LLM_ORACLE = {"op1_decontamination": OP1, "op3_chat": OP3, "op5_ngram_join": OP5, "op6_licences": _op6(), "op10_url_rules": _op10(),
              "op11_spelling": _op11(), "op12_collocations": OP12}
