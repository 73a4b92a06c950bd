"""SQL that gives the rows of the query of the same name, where SQL can express it.

The other queries are tested against brute force, exact round trips or held-out accuracy.
"""

_WARC = """
WITH d AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""

_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

_URL_LISTS = r"""
WITH p AS (
  SELECT page_id, url, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path,
    CAST(DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INTEGER) AS DATE) AS fetched_on FROM pages
), e AS (
  SELECT lower(CASE page_id % 3 WHEN 0 THEN host WHEN 1 THEN regexp_replace(host, '^[^.]+\.', '') ELSE host || path END) AS rule,
    CASE WHEN page_id % 2 = 0 THEN 2 WHEN page_id % 7 < 4 THEN 0 ELSE 1 END AS rank,
    CAST(DATE '2024-01-01' + CAST(page_id * 53 % 366 AS INTEGER) AS DATE) AS listed_on FROM p WHERE page_id % 5 = 0
), daily AS (
  SELECT rule, listed_on, max(rank) AS rank FROM e GROUP BY 1, 2
), holds AS (
  SELECT *, lead(listed_on) OVER (PARTITION BY rule ORDER BY listed_on) AS until FROM daily
), met AS (
  SELECT page_id, rule, rank, listed_on, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) AS n
  FROM p JOIN holds ON rank > 0 AND listed_on <= fetched_on AND (until IS NULL OR fetched_on < until)
    AND (rule = host OR rule = host || path OR ends_with(host, '.' || rule))
)
SELECT p.page_id, url, fetched_on, coalesce(rank = 2, FALSE) AS blocked, rule, listed_on
FROM p LEFT JOIN met ON met.page_id = p.page_id AND n = 1
"""


#: The 256 remainders of CRC-32, and the checksum of a text's UTF-8 bytes.
_CRC_TABLE = """
crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
)"""


def _crc32(text: str) -> str:
    hexed = f"hex(encode({text}))"
    data = f"list_transform(range(0, length({hexed}) // 2), lambda i: CAST('0x' || substr({hexed}, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {data}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


_SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE}, runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents
), hashed AS (
  SELECT run, n, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h
  FROM (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL), crc
), w AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING sum(n) >= 3 AND length(word) >= 5
), lacking AS (
  SELECT word, n, substr(word, 1, i) || '.' || substr(word, i + 2) AS k FROM (SELECT *, unnest(range(length(word))) AS i FROM w)
), whole AS (
  SELECT word, n, substr(word, 1, i) || '.' || substr(word, i + 1) AS k FROM (SELECT *, unnest(range(length(word) + 1)) AS i FROM w)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM lacking a JOIN lacking b USING (k) WHERE a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM lacking a JOIN whole b USING (k)
  UNION SELECT a.word, a.n, b.word, b.n FROM whole a JOIN lacking b USING (k)
), best AS (
  SELECT word, n, other, m, row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM near
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * w.n THEN other END AS form, CASE WHEN m >= 2 * w.n THEN m END AS form_n
  FROM w LEFT JOIN best ON best.word = w.word AND place = 1
), chain AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT chain.word, form FROM chain JOIN formed ON formed.word = root AND form IS NOT NULL
), ends AS (
  SELECT chain.word, root FROM chain JOIN formed ON formed.word = root AND form IS NULL
)
SELECT formed.word, form, root, n, n_near, form_n FROM formed JOIN ends ON ends.word = formed.word
"""


def _step(state: str, edit: str, cost: str, line: str) -> str:
    return f"struct_pack(c := {state}.c + {cost}, a := {state}.a || '{edit}', r := {state}.r || {line})"


def _cheapest(*options: str) -> str:
    """The least option whose state can be reached, by cost and then audit."""
    return f"list_min(list_filter([{', '.join(options)}], lambda o: o.c IS NOT NULL))"


_USER_LINE, _ASSISTANT_LINE = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
#: States: nothing said (n), a system row (s), a user row (u), an assistant row (a).
_INSERTED = {
    "u1": _cheapest("u", *(_step(x, "I", "5", _USER_LINE) for x in "nsa")),
    "a1": _cheapest("a", _step("u", "I", "5", _ASSISTANT_LINE)),
    "a2": _cheapest("a1", _step("u1", "I", "5", _ASSISTANT_LINE)),
}
_OWN, _CUT = "chr(10) || x.role || ':' || x.text", "CASE WHEN x.fault = 'truncated' THEN 5 ELSE 0 END"


def _kept(state: str, initial: str) -> str:
    return f"CASE WHEN x.fault NOT IN ('blank', 'duplicate') AND x.role[1] = '{initial}' THEN {_step(state, 'K', _CUT, _OWN)} END"


def _rerole(state: str, name: str) -> str:
    return f"CASE WHEN x.fault NOT IN ('blank', 'duplicate') THEN {_step(state, 'R', f'1 + {_CUT}', f"chr(10) || '{name}:' || x.text")} END"


def _deleted(state: str) -> str:
    return _step(state, "D", "2", "''")


_REPAIR = f"""
WITH RECURSIVE {_CRC_TABLE}, hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS h
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE h <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ended FROM damaged
), judged AS (
  SELECT *, CASE WHEN ended = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
    WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    coalesce(lag(role[1]) OVER (PARTITION BY conv_id ORDER BY place) || role[1] NOT IN ('su', 'ua', 'au'), FALSE) AS broken FROM placed
), convs AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (broken) AS illegal, list(struct_pack(role, text, fault) ORDER BY place) AS rows
  FROM judged GROUP BY conv_id
), walk AS (
  SELECT conv_id, 0 AS k, rows, struct_pack(c := 0, a := '', r := '') AS n, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, r VARCHAR)) AS s,
    CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, r VARCHAR)) AS u, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, r VARCHAR)) AS a FROM convs
  UNION ALL
  SELECT conv_id, k, rows, {_deleted("n")}, {_cheapest(_deleted("s"), _kept("n", "s"))},
    {_cheapest(_deleted("u1"), *(f(x, y) for x in ("n", "s", "a2") for f, y in ((_kept, "u"), (_rerole, "user"))))},
    {_cheapest(_deleted("a2"), _kept("u1", "a"), _rerole("u1", "assistant"))}
  FROM (
    SELECT *, {_INSERTED["a2"]} AS a2 FROM (SELECT conv_id, k + 1 AS k, rows, rows[k + 1] AS x, n, s, u, a, {_INSERTED["u1"]} AS u1, {_INSERTED["a1"]} AS a1 FROM walk WHERE k < len(rows))
  )
), ends AS (
  SELECT conv_id, {_cheapest("n", "a2")} AS best FROM (SELECT *, {_INSERTED["a2"]} AS a2 FROM (SELECT *, {_INSERTED["u1"]} AS u1, {_INSERTED["a1"]} AS a1 FROM walk WHERE k = len(rows)))
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit, sha256(substr(coalesce(best.r, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN convs ON convs.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": _WARC, "op7_top_k": _TOP_K, "op8_url_lists": _URL_LISTS, "op12_spelling": _SPELLING, "op13_repair": _REPAIR}
