"""The named queries of this subpackage and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from abacarium.llm import toxicity
from abacarium.llm.bbit_minhash import near_copies
from abacarium.llm.bpe import build_encoder, round_trip, token_lengths
from abacarium.llm.common import read_table, remainder, vocabulary_path
from abacarium.llm.exact_dedup import exact_groups
from abacarium.llm.jaccard import similar_groups
from abacarium.llm.language import fit, predict
from abacarium.llm.line_dedup import repeated_lines
from abacarium.llm.pii import find_personal
from abacarium.llm.prefix_trie import borrowed_trie
from abacarium.llm.sharding import assign_shards
from abacarium.llm.token_counts import length_histogram, suffix_sums
from abacarium.llm.turn_repair import damaged, repair
from abacarium.llm.winnow import decontaminate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"))


CHECKS["op7_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER same AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = first_value(doc_id) OVER same AS kept,
       sha256(body) AS text_sha256
FROM t
WINDOW same AS (PARTITION BY body ORDER BY chars DESC, doc_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


CHECKS["op9_decontamination"] = r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size,
         array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS body
  FROM item, unnest(generate_series(1, greatest(1, len(w) - 12))) AS s(i) WHERE len(w) > 0),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
spots AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS body
  FROM doc, sizes, unnest(generate_series(1, len(w) - size + 1)) AS s(i) WHERE len(w) >= size),
found AS (SELECT doc_id, i, size, item_id FROM spots JOIN windows USING (size, body)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, i, size FROM found), unnest(generate_series(i, i + size - 1)) AS s(p) GROUP BY doc_id),
ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)"""


@query
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return round_trip(docs, build_encoder(docs, vocabulary_path()))


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 4) == 2
    return predict(docs, fit(docs.where(~held_out)), "doc_id", "text", held_out.alias("held_out"))


@query
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(read_table(spark, sf_dir, "documents"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return suffix_sums(length_histogram(token_lengths(docs, build_encoder(docs, vocabulary_path()))))


#: Bytes of text that a shard of op4 may hold; small enough that the given tables are split over several levels.
SHARD_BYTES = 64 << 10


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(read_table(spark, sf_dir, "documents"), SHARD_BYTES)


CHECKS["op4_sharding"] = f"""
WITH t AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h FROM documents),
levels AS (SELECT doc_id, n_bytes, d AS depth, h >> (60 - d) AS prefix FROM t, unnest(generate_series(0, 60)) AS s(d)),
sums AS (
  SELECT *, sum(n_bytes) OVER (PARTITION BY depth, prefix) AS total, count(*) OVER (PARTITION BY depth, prefix) AS docs FROM levels),
leaf AS (
  SELECT doc_id, min(depth) FILTER (WHERE total <= {SHARD_BYTES} OR depth = 60) AS depth FROM sums GROUP BY doc_id)
SELECT doc_id, n_bytes, CAST(depth AS INTEGER) AS depth,
       CASE WHEN depth = 0 THEN '' ELSE right(lpad(bin(prefix), 64, '0'), CAST(depth AS INTEGER)) END AS shard,
       CAST(total AS BIGINT) AS shard_bytes, docs AS shard_docs, total <= {SHARD_BYTES} AS fits
FROM sums JOIN leaf USING (doc_id, depth)"""


@query
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal(read_table(spark, sf_dir, "documents"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = read_table(spark, sf_dir, "documents"), remainder("doc_id", 5) == 0
    labels = read_table(spark, sf_dir, "labels").where(~held_out)
    return toxicity.score(docs, toxicity.fit(docs, labels), "doc_id", "text", held_out.alias("held_out"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_lines(read_table(spark, sf_dir, "documents"))
    return found.withColumn("dropped", F.array_join(F.col("dropped").cast("array<string>"), ","))


@query
def op12_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(read_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def _groups_check(percent: int, more: str = "") -> str:
    """All pairs of documents by their shared shingles, and the smallest id reachable over links."""
    return rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ 	-
]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM t, unnest(generate_series(1, greatest(1, len(w) - 2))) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * i >= {percent} * (nx.n + ny.n - i)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.y FROM r JOIN l ON l.x = r.b),
c AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(b, doc_id) AS component_id{more}
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN c ON a = doc_id"""


CHECKS["op12_near_copies"] = _groups_check(85, ", coalesce(b, doc_id) = doc_id AS kept")
CHECKS["op2_jaccard_join"] = _groups_check(90)


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return borrowed_trie(read_table(spark, sf_dir, "conversations"))


def _crc32(text: str) -> str:
    """The crc32 of an ASCII text, byte by byte and bit by bit (DuckDB has no function for it)."""
    codes = f"list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    one = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), lambda a, b: {one}), 4294967295)"


CHECKS["op13_prefix_trie"] = f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p,
         coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id AS c, conv_id - conv_id % 5 AS lender, {_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM t),
size AS (SELECT conv_id, max(p) AS n FROM t GROUP BY conv_id),
built AS (
  SELECT c, p AS d, r, x FROM ids JOIN t ON conv_id = lender WHERE p <= h
  UNION ALL
  SELECT c, p - h + least(h, coalesce(n, 0)), r, x FROM ids JOIN t ON t.conv_id = c LEFT JOIN size ON size.conv_id = lender WHERE p > h),
path AS (
  SELECT c, 0 AS d, '' AS k, 0 AS b FROM ids
  UNION ALL
  SELECT c, d, string_agg(md5(length(r) || ':' || r || x), '') OVER (PARTITION BY c ORDER BY d), strlen(x) FROM built),
node AS (SELECT k, any_value(d) AS d, min(c) AS c, count(*) AS n, any_value(b) AS b FROM path GROUP BY k),
kids AS (SELECT left(k, 32 * (d - 1)) AS k, count(*) AS kids FROM node WHERE d > 0 GROUP BY ALL),
full_node AS (SELECT node.*, coalesce(kids, 0) AS kids FROM node LEFT JOIN kids USING (k)),
tree AS (
  SELECT a.k, count(*) FILTER (WHERE b.kids = 0) AS leaves, sum((b.n - 1) * b.b) AS saved
  FROM full_node a JOIN full_node b ON starts_with(b.k, a.k) GROUP BY a.k),
ends AS (
  SELECT k, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS list
  FROM (SELECT c, arg_max(k, d) AS k FROM path GROUP BY c) GROUP BY k)
SELECT f.c AS conv_id, CAST(f.d AS BIGINT) AS depth, up.c AS parent_conv_id, f.n AS n_convs, f.kids AS n_children,
       leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(list, '')) AS ends_sha256
FROM full_node f JOIN tree USING (k) LEFT JOIN ends USING (k) LEFT JOIN node up ON f.d > 0 AND up.k = left(f.k, 32 * (f.d - 1))"""


@query
def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    return repair(damaged(conversations), conversations.select("conv_id"))


def _repair_check() -> str:
    """One step of the recursion for every turn and two for insertions before it; a state keeps its best way."""
    start, s, u, a = (f"w.st[{i}]" for i in (1, 2, 3, 4))

    def add(state: str, cost: str, letter: str, line: str = "''") -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {line}}}"

    def best(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    def taken(state: str, initial: str, role: str) -> str:
        kept, other = add(state, "o.late", "K", "o.role || ':' || o.text || chr(10)"), add(state, "3 + o.late", "R", f"'{role}:' || o.text || chr(10)")
        return f"CASE WHEN o.initial = '{initial}' THEN {kept} ELSE {other} END"

    def told(state: str, role: str) -> str:
        return add(state, "3", "I", f"'{role}:' || chr(10)")

    gone = [add(x, "4", "D") for x in (start, s, u, a)]
    system = f"CASE WHEN o.initial = 's' THEN {add(start, 'o.late', 'K', "o.role || ':' || o.text || chr(10)")} ELSE {{'c': 1000000000, 'a': '', 't': ''}} END"
    inserted = f"[{start}, {s}, {best(u, told(start, 'user'), told(s, 'user'), told(a, 'user'))}, {best(a, told(u, 'assistant'))}]"
    edited = (f"[{gone[0]}, {best(gone[1], system)}, {best(gone[2], taken(start, 'u', 'user'), taken(s, 'u', 'user'), taken(a, 'u', 'user'))}, "
              f"{best(gone[3], taken(u, 'a', 'assistant'))}]")
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ')"
    return rf"""
WITH RECURSIVE named AS (
  SELECT conv_id, {key} AS key, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32(f"{key} || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations),
rows_ AS (
  SELECT key, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM named, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS c(n) WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, text) AS i,
         regexp_extract(text, '(?s)([^ 	-
])[ 	-
]*\z', 1) AS final FROM rows_),
marked AS (
  SELECT *, left(role, 1) AS initial, CASE WHEN final = '' THEN 'b' WHEN row_number() OVER (PARTITION BY key, role, text ORDER BY i) > 1 THEN 'd'
                 WHEN final NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY key ORDER BY i) || left(role, 1) AS pair FROM placed),
facts AS (
  SELECT key, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
         count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM marked GROUP BY key),
steps AS (
  SELECT key, 3 * i + x AS i, x < 2 AS adds, role, text, initial, fault IN ('b', 'd') AS must, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS late
  FROM marked, unnest([0, 1, 2]) AS u(x)
  UNION ALL SELECT key, 3 * n + 3 + x, true, '', '', '', false, 0 FROM facts, unnest([0, 1]) AS u(x)),
walk AS (
  SELECT key, CAST(2 AS BIGINT) AS i, [{{'c': CAST(0 AS BIGINT), 'a': '', 't': ''}}, {{'c': 1000000000, 'a': '', 't': ''}},
         {{'c': 1000000000, 'a': '', 't': ''}}, {{'c': 1000000000, 'a': '', 't': ''}}] AS st FROM facts
  UNION ALL
  SELECT w.key, o.i, CASE WHEN o.adds THEN {inserted} WHEN o.must THEN [{', '.join(gone)}] ELSE {edited} END
  FROM walk w JOIN steps o ON o.key = w.key AND o.i = w.i + 1),
done AS (SELECT walk.key, list_min([st[1], st[4]]) AS r FROM walk JOIN facts ON facts.key = walk.key AND walk.i = 3 * n + 4)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(r.c, 0) AS cost, coalesce(r.a, '') AS audit,
       sha256(coalesce(CASE WHEN r.t = '' THEN '' ELSE left(r.t, length(r.t) - 1) END, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, key FROM named) LEFT JOIN facts USING (key) LEFT JOIN done USING (key)"""


CHECKS["op11_turn_repair"] = _repair_check()

#: All pairs of different lines. The operator proposes pairs by signatures, so a link may be missed with a small chance.
CHECKS["op8_line_dedup"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
t AS (SELECT doc_id, i, trim(parts[i + 1], ' ') AS x FROM d, unnest(generate_series(0, len(parts) - 1)) AS u(i)),
names AS (SELECT x, row_number() OVER () AS id FROM (SELECT DISTINCT x FROM t WHERE x <> '')),
s AS (SELECT DISTINCT id, substr(x, j, 5) AS g FROM names, unnest(generate_series(1, greatest(1, length(x) - 4))) AS u(j)),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
sized AS (SELECT s.id, g, n FROM s JOIN n USING (id)),
p AS (
  SELECT a.id AS x, b.id AS y, a.n + b.n AS total, count(*) AS i FROM sized a JOIN sized b ON a.g = b.g AND a.id < b.id
  AND 10 * least(a.n, b.n) >= 8 * greatest(a.n, b.n) GROUP BY ALL),
one AS (SELECT x, y FROM p WHERE 100 * i >= 80 * (total - i)),
l AS (SELECT x, y FROM one UNION ALL SELECT y, x FROM one),
r AS (SELECT id AS a, id AS b FROM names UNION SELECT r.a, l.y FROM r JOIN l ON l.x = r.b),
c AS (SELECT a AS id, min(b) AS root FROM r GROUP BY a),
placed AS (SELECT doc_id, i, root FROM t JOIN names USING (x) JOIN c USING (id)),
lost AS (
  SELECT doc_id, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS dropped, count(*) AS gone
  FROM (SELECT *, row_number() OVER (PARTITION BY root ORDER BY doc_id, i) AS k FROM placed) WHERE k > 1 GROUP BY doc_id)
SELECT doc_id, CAST(len(parts) AS BIGINT) AS n_lines, CAST(len(parts) - coalesce(gone, 0) AS BIGINT) AS n_kept,
       coalesce(dropped, '') AS dropped FROM d LEFT JOIN lost USING (doc_id)"""
