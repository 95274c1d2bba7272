"""SQL twins of the operators' queries, for another engine. They search plainly, without the operators' methods."""

from __future__ import annotations

from countyloom.llm.license_scan import PHRASES, TEMPLATES, THRESHOLD

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _words(value: str) -> str:
    return "[" + ", ".join(map(_text, value)) + "]"


URLS = f"""
WITH cut AS (
  SELECT row_number() OVER () AS rid, page_id,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), hosts AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
parts AS (
  SELECT rid, page_id, {_LOWER.format("raw")} AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM hosts
), rules(verdict, h, p) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')
)
SELECT page_id, host, path, h || p AS rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(h || p) DESC) = 1
"""

_TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

RANKED = f"""
WITH doc AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_TERM}) AS terms
  FROM documents
), sized AS (SELECT rid, doc_id, terms, len(terms)::BIGINT AS n FROM doc WHERE len(terms) > 0),
corpus AS (SELECT count(*)::BIGINT AS docs, coalesce(sum(n), 0)::BIGINT AS total FROM sized),
item AS (
  SELECT row_number() OVER () AS iid, item_id, list_distinct(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_TERM})) AS terms
  FROM benchmark
), asked AS (SELECT iid, unnest(terms) AS term FROM item),
held AS (SELECT rid, unnest(terms) AS term FROM sized),
tf AS (SELECT rid, term, count(*)::BIGINT AS tf FROM held WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
weight AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, corpus),
factor AS (SELECT rid, doc_id, 100 - 90 + ((90 * n * docs) // total) AS m FROM sized, corpus),
impact AS (
  SELECT rid, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS impact
  FROM tf JOIN weight USING (term) JOIN factor USING (rid)
), scored AS (
  SELECT iid, rid, doc_id, sum(impact)::BIGINT AS score FROM asked JOIN impact USING (term) GROUP BY ALL HAVING sum(impact) > 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scored
)
SELECT item_id, rank, doc_id, score FROM ranked JOIN item USING (iid) WHERE rank <= 10
"""


def licenses() -> str:
    phrases = ", ".join(f"({_words(p.split(' '))}, {_text(label)})" for p, label in PHRASES.items())
    templates = ", ".join(
        f"({_text(t.label)}, {len(t.words)}, {_words(sorted(t.distinct))}, {t.least(THRESHOLD)})" for t in TEMPLATES
    )
    return f"""
WITH doc AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
), phrase(parts, label) AS (VALUES {phrases}),
place AS (
  SELECT rid, pos, label
  FROM (SELECT rid, words, unnest(range(1, len(words) + 1)) AS pos FROM doc) spots, phrase
  WHERE words[pos] = parts[1] AND words[pos : pos + len(parts) - 1] = parts
), base AS (
  SELECT rid, count(*)::BIGINT AS n_base, min(pos) - 1 AS first_word, max(pos) - 1 AS last_word, list(DISTINCT label) AS found
  FROM place GROUP BY rid
), template(label, step, parts, least) AS (VALUES {templates}),
block AS (
  SELECT rid, label, parts, least, words[k * step + 1 : k * step + 2 * step] AS held
  FROM (SELECT rid, words, label, parts, least, step, unnest(range(0, (len(words) + step - 1) // step)) AS k FROM doc, template)
), met AS (
  SELECT rid, label, len(list_intersect(parts, held))::DOUBLE / len(parts) AS score
  FROM block WHERE len(list_intersect(parts, held)) >= least
), more AS (SELECT rid, list(DISTINCT label) AS found, max(score) AS score FROM met GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base.found), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.found, []), coalesce(more.found, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0.0) END::DOUBLE AS score
FROM doc LEFT JOIN base USING (rid) LEFT JOIN more USING (rid)
"""


_WHITE = r"\x20\x09-\x0D"


def conversations() -> str:
    """The least edits by tables of the best way from every row and state to the end, row by row from the last."""

    def better(*ways: str) -> str:
        return f"list_min(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))"

    def way(cost: str, edit: str, rest: str, test: str = "true") -> str:
        return f"CASE WHEN {test} AND {rest} IS NOT NULL THEN {{'cost': {rest}.cost + {cost}, 'audit': '{edit}' || {rest}.audit}} END"

    def over(state: str, after: str, wanted: str) -> list[str]:
        mine = f"letter = '{wanted}'"
        live = "NOT gone"
        return [
            way("4", "D", f"b.{state}"),
            way("cut", "K", f"b.{after}", f"{live} AND {mine}"),
            way("cut + 3", "R", f"b.{after}", f"{live} AND NOT ({mine})"),
        ]

    system = way("cut", "K", "b.opened", "NOT gone AND letter = 's'")
    rows = {
        "nothing": better(*over("nothing", "asked", "u"), system),
        "opened": better(*over("opened", "asked", "u")),
        "asked": better(*over("asked", "answered", "a")),
        "answered": better(*over("answered", "asked", "u")),
    }
    follows = {"nothing": "asked", "opened": "asked", "asked": "answered", "answered": "asked"}

    def added(source: str) -> str:
        parts = ", ".join(f"{better(s, way('3', 'I', n))} AS {s}" for s, n in follows.items())
        return f"SELECT * EXCLUDE (nothing, opened, asked, answered), {parts} FROM ({source})"

    stepped = (
        "SELECT r.cid, r.pos, "
        + ", ".join(f"{sql} AS {name}" for name, sql in rows.items())
        + " FROM best b JOIN row_ r ON r.cid = b.cid AND r.pos = b.pos - 1"
    )
    some, none = "{'cost': 0::BIGINT, 'audit': ''}", "NULL::STRUCT(cost BIGINT, audit VARCHAR)"
    start = f"SELECT cid, n + 1 AS pos, {some} AS nothing, {none} AS opened, {none} AS asked, {some} AS answered FROM size_"

    def closed(source: str) -> str:
        """With up to three rows added before what comes next."""
        return added(added(added(source)))

    return rf"""
WITH RECURSIVE slot AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY b) AS crc
  FROM (SELECT unnest(range(256))::BIGINT AS b)
), original AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations
), marked AS (
  SELECT conv_id, turn, role, text, xor(
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, x: xor(c >> 8, crc[xor(c, x) % 256 + 1])), 4294967295) % 20 AS kind
  FROM original, slot
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM marked, (SELECT unnest(range(2)) AS copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
), convs AS (SELECT row_number() OVER () AS cid, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)),
placed AS (
  SELECT cid, turn, role, text, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM damaged d JOIN convs c ON d.conv_id IS NOT DISTINCT FROM c.conv_id
), tested AS (
  SELECT *, regexp_extract(text, '([^{_WHITE}])[{_WHITE}]*$', 1) AS last_,
    row_number() OVER (PARTITION BY cid, role, text ORDER BY pos) > 1 AS again,
    lag(left(role, 1)) OVER (PARTITION BY cid ORDER BY pos) AS before
  FROM placed
), row_ AS (
  SELECT cid, pos, role, text, left(role, 1) AS letter, last_ = '' OR again AS gone,
    CASE WHEN last_ IN ('.', '!', '?') THEN 0 ELSE 3 END AS cut
  FROM tested
), size_ AS (SELECT cid, coalesce(max(pos), 0) AS n FROM convs LEFT JOIN placed USING (cid) GROUP BY cid),
best AS (
  SELECT cid, pos, nothing, opened, asked, answered FROM ({closed(start)})
  UNION ALL
  SELECT cid, pos, nothing, opened, asked, answered FROM ({closed(stepped)})
), chosen AS (SELECT cid, nothing.cost AS cost, nothing.audit AS audit FROM best WHERE pos = 1),
edit AS (
  SELECT cid, k, audit[k] AS edit, k - len(regexp_replace(audit[1 : k], '[^I]', '', 'g')) AS pos,
    k - len(regexp_replace(audit[1 : k], '[^D]', '', 'g')) AS place
  FROM (SELECT cid, audit, unnest(range(1, len(audit) + 1)) AS k FROM chosen)
), kept AS (
  SELECT e.cid, e.place, e.edit, r.role, coalesce(CASE WHEN e.edit <> 'I' THEN r.text END, '') AS text,
    max(CASE WHEN e.place = 1 AND e.edit = 'K' AND letter = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.cid) AS opened
  FROM edit e LEFT JOIN row_ r ON r.cid = e.cid AND r.pos = e.pos WHERE e.edit <> 'D'
), repaired AS (
  SELECT cid, string_agg(
    CASE WHEN edit = 'K' THEN role WHEN (place - opened) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY place) AS whole
  FROM kept GROUP BY cid
), counts AS (
  SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (last_ = '')::BIGINT AS blank,
    count(*) FILTER (last_ <> '' AND again)::BIGINT AS duplicate,
    count(*) FILTER (last_ NOT IN ('', '.', '!', '?') AND NOT again)::BIGINT AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || left(role, 1) NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal
  FROM tested GROUP BY cid
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost::BIGINT AS cost, audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM convs JOIN chosen USING (cid) LEFT JOIN counts USING (cid) LEFT JOIN repaired USING (cid)
"""


def statements() -> dict[str, str]:
    return {
        "op3_url_cascade": URLS,
        "op11_ranked_search": RANKED,
        "op12_license_scan": licenses(),
        "op13_conversation_repair": conversations(),
    }
