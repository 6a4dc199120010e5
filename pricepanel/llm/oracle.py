"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from pricepanel.llm.sharding import BITS, hilbert_table

_GAP = r"[ \t\n\x0B\f\r]+"
_WORDS = f"list_filter(string_split_regex(coalesce(text, ''), '{_GAP}'), lambda x: x <> '')"

# Measures of every row of ``documents_in``, a row number added, as ``measured``.
_MEASURED = rf"""
rows_in AS (SELECT *, row_number() OVER () AS rid, {_WORDS} AS w,
                   list_filter(string_split(coalesce(text, ''), chr(10)),
                               lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS l
            FROM documents_in),
windows AS (SELECT rid, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS g
            FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 2)) AS i FROM rows_in)),
repeated AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows)
             WHERE c >= 2),
covered AS (SELECT rid, count(DISTINCT p) AS c
            FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY rid),
plain AS (SELECT rows_in.* EXCLUDE (w, l), CAST(len(w) AS BIGINT) AS n_words,
                 CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                 CAST(length(coalesce(text, ''))
                      - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS BIGINT)
                   AS n_symbols,
                 CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
                 CAST(coalesce(c, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines
          FROM rows_in LEFT JOIN covered USING (rid)),
measured AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM plain),
failing AS (SELECT *, base_failed OR 100 * n_symbols > 10 * word_chars
                      OR 100 * n_dup_lines > 30 * n_lines AS failed FROM measured),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (failed) AS f FROM failing GROUP BY source),
overall AS (SELECT sum(f) / sum(n) AS m, sum(n) AS docs, count(*) AS h FROM hosts),
spread AS (SELECT m, sum(n * pow(f / n - m, 2)) / any_value(docs)
                     - m * (1 - m) * any_value(h) / any_value(docs) AS between_hosts
           FROM hosts, overall GROUP BY m),
prior AS (SELECT m, greatest(m * (1 - m) / greatest(between_hosts, 1e-9) - 1, 1.0) AS k FROM spread),
verdicts AS (SELECT source, (f + m * k) / (n + k) > 0.5 AS rejected FROM hosts, prior),
judged AS (SELECT measured.*, NOT base_failed AND NOT rejected AS kept
           FROM measured JOIN verdicts ON measured.source IS NOT DISTINCT FROM verdicts.source)"""

QUALITY_RULES = f"""
WITH documents_in AS (SELECT * FROM documents), {_MEASURED}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
FROM judged"""

# What the mix takes of every row of ``documents_in``, as ``mixed``.
_MIXED = rf"""
sized AS (SELECT *, CAST(len({_WORDS}) AS BIGINT) AS mix_size, md5(coalesce(text, '')) AS mix_digest
          FROM documents_in),
keyed AS (SELECT *, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || mix_digest || ':'
                        || CAST(row_number() OVER (PARTITION BY source, doc_id, mix_digest) - 1
                                AS VARCHAR)) AS mix_key
          FROM sized),
totals AS (SELECT source, CAST(sum(mix_size) AS BIGINT) AS source_size FROM keyed GROUP BY source),
weighted AS (SELECT source, source_size,
                    [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
             FROM totals),
whole_mix AS (SELECT 1.5::DOUBLE * sum(source_size) AS words, sum(weight) AS weights FROM weighted),
fills AS (SELECT source_size, weight,
                 (words - coalesce(sum(2 * source_size) OVER earlier, 0))
                 / (weights - coalesce(sum(weight) OVER earlier, 0)) AS level
          FROM weighted, whole_mix
          WINDOW earlier AS (ORDER BY 2 * source_size / weight, source NULLS LAST
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (SELECT max(level) AS level FROM fills WHERE level * weight <= 2 * source_size),
targets AS (SELECT source, source_size,
                   CAST(CASE WHEN level * weight <= 2 * source_size THEN level * weight
                             ELSE 2 * source_size END AS DOUBLE) AS target FROM weighted, water),
whole AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole
          FROM targets),
placed AS (SELECT keyed.*, source_size, target, whole, target - whole * source_size AS rest,
                  coalesce(sum(mix_size) OVER (PARTITION BY keyed.source ORDER BY mix_key
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS so_far
           FROM keyed JOIN whole ON keyed.source IS NOT DISTINCT FROM whole.source),
mixed AS (SELECT *, CAST(whole AS BIGINT)
                    + CASE WHEN 2 * so_far + mix_size <= 2 * rest THEN 1 ELSE 0 END AS repetitions
          FROM placed)"""

MIXING = f"""
WITH documents_in AS (SELECT * FROM documents), {_MIXED}
SELECT doc_id, mix_size AS size, source_size, target, CAST(repetitions * mix_size AS BIGINT) AS taken
FROM mixed"""



def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


_LOWERED = _lower("coalesce(text, '')")
_LOWER_WORDS = f"list_filter(string_split_regex({_LOWERED}, '{_GAP}'), lambda x: x <> '')"

# Class of every row of ``documents_in``, as ``classed``: doc_id, n_shingles, component_id.
_CLASSED = f"""
worded AS (SELECT row_number() OVER () AS rid, doc_id AS did, {_LOWER_WORDS} AS w
                     FROM documents_in),
shingled AS (SELECT DISTINCT rid, did, g FROM (
               SELECT rid, did, concat_ws(' ', w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) AS g
               FROM (SELECT rid, did, w, unnest(generate_series(1, len(w) - 4)) AS i FROM worded)
               UNION ALL
               SELECT rid, did, array_to_string(w, ' ') FROM worded WHERE len(w) BETWEEN 1 AND 4)),
sizes AS (SELECT rid, count(*) AS n FROM shingled GROUP BY rid),
common AS (SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM shingled a JOIN shingled b USING (g)
           WHERE a.rid <> b.rid GROUP BY ALL),
linked AS (SELECT a, b FROM common JOIN sizes x ON x.rid = a JOIN sizes y ON y.rid = b
           WHERE 100 * c >= 80 * (x.n + y.n - c)),
reached AS (SELECT rid AS a, rid AS b FROM worded
            UNION SELECT reached.a, linked.b FROM reached JOIN linked ON linked.a = reached.b),
classed AS (SELECT worded.rid, any_value(worded.did) AS doc_id, min(other.did) AS component_id,
                   CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles
            FROM worded JOIN reached ON reached.a = worded.rid
            JOIN worded other ON other.rid = reached.b LEFT JOIN sizes ON sizes.rid = worded.rid
            GROUP BY worded.rid)"""

JACCARD_JOIN = f"""
WITH RECURSIVE documents_in AS (SELECT * FROM documents), {_CLASSED}
SELECT doc_id, n_shingles, component_id FROM classed"""

WARC = """
WITH paid AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
told AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
                sha256(payload) AS payload_digest FROM paid),
first AS (SELECT payload_digest, min(page_id) AS first_id FROM told
          WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END
         AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM told LEFT JOIN first USING (payload_digest)"""

_ITEM_WORDS = (
    f"list_filter(string_split_regex({_LOWERED}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
)

# Hits of every row of ``documents_in``, as ``hit_rows``.
_HIT = f"""
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS w FROM benchmark),
patterns AS (SELECT DISTINCT item, 13 AS len, array_to_string(w[i:i + 12], ' ') AS p
             FROM (SELECT item, w, unnest(generate_series(1, len(w) - 12)) AS i FROM items)
             UNION
             SELECT item, len(w), array_to_string(w, ' ') FROM items WHERE len(w) BETWEEN 1 AND 12),
texts AS (SELECT row_number() OVER () AS hid, *, {_ITEM_WORDS} AS hw FROM documents_in),
lengths AS (SELECT DISTINCT len FROM patterns),
slices AS (SELECT hid, i, len, array_to_string(hw[i:i + len - 1], ' ') AS p
           FROM (SELECT hid, hw, len, unnest(generate_series(1, len(hw) - len + 1)) AS i
                 FROM texts, lengths)),
found AS (SELECT hid, i, len, item FROM slices JOIN patterns USING (len, p)),
words_hit AS (SELECT hid, count(DISTINCT place) AS n FROM (
                SELECT hid, unnest(generate_series(i, i + len - 1)) AS place FROM found) GROUP BY hid),
items_hit AS (SELECT hid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
              FROM (SELECT DISTINCT hid, item FROM found) GROUP BY hid),
hit_rows AS (SELECT texts.*, CAST(len(hw) AS BIGINT) AS n_words,
                    CAST(coalesce(words_hit.n, 0) AS BIGINT) AS n_hit,
                    CAST(coalesce(items_hit.n, 0) AS BIGINT) AS n_items,
                    sha256(coalesce(names, '')) AS items_sha256,
                    coalesce(words_hit.n, 0) > 0 AND 20 * words_hit.n >= len(hw) AS contaminated
             FROM texts LEFT JOIN words_hit USING (hid) LEFT JOIN items_hit USING (hid))"""

DECONTAMINATION = f"""
WITH documents_in AS (SELECT * FROM documents), {_HIT}
SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM hit_rows"""



def _crc_steps() -> list[int]:
    """What four bits add to the reflected checksum."""
    steps = list(range(16))
    for _ in range(4):
        steps = [s >> 1 ^ (0xEDB88320 if s & 1 else 0) for s in steps]
    return steps


def _crc_of(text: str) -> str:
    """The checksum of a text, which takes the low half of a byte first."""
    halves = (
        f"list_transform(string_split(regexp_replace(hex(encode({text})), '(.)(.)', '\\2\\1', 'g'), "
        "''), lambda c: instr('0123456789ABCDEF', c) - 1)"
    )
    return (
        f"CASE WHEN {text} = '' THEN 0 ELSE xor(4294967295, list_reduce({halves}, lambda c, h: "
        f"xor(c >> 4, {_crc_steps()}[1 + (xor(c, h) & 15)]), 4294967295::BIGINT)) END"
    )


_CRC = _crc_of("coalesce(text, '')")

# Place of every row of ``documents_in``, as ``sharded``.
_SHARDED = f"""
shard_rows AS (SELECT *, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS shard_size FROM documents_in),
n_rows AS (SELECT count(*) AS total FROM shard_rows),
source_cells AS (SELECT source, (sum(n) OVER (ORDER BY source NULLS FIRST) - n) * 16 // total AS source_cell
                 FROM (SELECT source, count(*) AS n FROM shard_rows GROUP BY source), n_rows),
lang_cells AS (SELECT lang, (sum(n) OVER (ORDER BY lang NULLS FIRST) - n) * 16 // total AS lang_cell
               FROM (SELECT lang, count(*) AS n FROM shard_rows GROUP BY lang), n_rows),
curved AS (SELECT shard_rows.*, {hilbert_table(3, BITS)}[CAST(1 + (source_cell * 16 + lang_cell) * 16
                    + least(15, greatest(0, length(bin(shard_size)) - 5)) AS BIGINT)] AS curve
           FROM shard_rows
           JOIN source_cells ON shard_rows.source IS NOT DISTINCT FROM source_cells.source
           JOIN lang_cells ON shard_rows.lang IS NOT DISTINCT FROM lang_cells.lang),
numbered AS (SELECT *, row_number() OVER (ORDER BY curve, doc_id NULLS FIRST, shard_size) - 1 AS place
             FROM curved),
sharded AS (SELECT *, CAST(place * 16 // total AS INTEGER) AS shard,
                   CAST(place - (place * 16 // total * total + 15) // 16 AS BIGINT) AS slot
            FROM numbered, n_rows)"""

SHARDING = f"""
WITH documents_in AS (SELECT * FROM documents), {_SHARDED}
SELECT doc_id, shard_size AS size, CAST({_CRC} AS BIGINT) AS text_crc32, 'rows' AS law, shard, slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM sharded"""

def _leaf(text: str) -> str:
    fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    told = (f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields)
    return f"sha256({' || '.join(told)})"


MERKLE = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf,
         CASE WHEN {_crc_of("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {_leaf(_lower("text"))}
              ELSE {_leaf("text")} END AS found
  FROM documents),
ranked AS (SELECT row_number() OVER () AS rid, *,
                  dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
                  count(*) OVER (PARTITION BY source) AS n FROM hashed),
lower_tree AS (SELECT 0 AS height, tree, rank, n, leaf AS digest FROM ranked
          UNION ALL
          SELECT height + 1, tree, rank // 16, any_value((n + 15) // 16),
                 sha256(string_agg(digest, '' ORDER BY rank))
          FROM lower_tree WHERE n > 1 GROUP BY height, tree, rank // 16),
subroots AS (SELECT tree, digest AS subroot FROM lower_tree WHERE n = 1),
upper_tree AS (SELECT 0 AS height, tree AS rank, (SELECT count(*) FROM subroots) AS n,
                 subroot AS digest FROM subroots
          UNION ALL
          SELECT height + 1, rank // 16, any_value((n + 15) // 16),
                 sha256(string_agg(digest, '' ORDER BY rank))
          FROM upper_tree WHERE n > 1 GROUP BY height, rank // 16),
nodes AS (SELECT 0 AS part, height, tree, rank, n, digest FROM lower_tree
          UNION ALL SELECT 1, height, 0, rank, n, digest FROM upper_tree),
beside AS (SELECT part, height, tree, rank, n,
                  coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING
                    AND 1 PRECEDING), '') AS l,
                  coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING
                    AND UNBOUNDED FOLLOWING), '') AS r
           FROM nodes WINDOW run AS (PARTITION BY part, height, tree, rank // 16 ORDER BY rank)),
folded AS (SELECT rid, tree AS own, 0 AS part, 0 AS height, tree, rank, n, found AS digest,
                  '' AS proof FROM ranked
           UNION ALL
           SELECT rid, own,
                  CASE WHEN f.n = 1 THEN 1 ELSE f.part END,
                  CASE WHEN f.n = 1 THEN 0 ELSE f.height + 1 END,
                  CASE WHEN f.n = 1 THEN 0 ELSE f.tree END,
                  CASE WHEN f.n = 1 THEN own ELSE f.rank // 16 END,
                  CASE WHEN f.n = 1 THEN (SELECT count(*) FROM subroots) ELSE (f.n + 15) // 16 END,
                  CASE WHEN f.n = 1 THEN digest ELSE sha256(l || digest || r) END,
                  CASE WHEN f.n = 1 THEN proof ELSE proof || l || r END
           FROM folded f JOIN beside b ON b.part = f.part AND b.height = f.height
             AND b.tree = f.tree AND b.rank = f.rank
           WHERE f.n > 1 OR f.part = 0),
ends AS (SELECT rid, digest, proof FROM folded WHERE part = 1 AND n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, ends.digest AS folded_root,
       ends.digest = root AS verified
FROM ranked JOIN ends USING (rid) JOIN subroots USING (tree),
     (SELECT digest AS root FROM upper_tree WHERE n = 1)"""

EXACT_DEDUP = """
WITH told AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
placed AS (SELECT *, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept
           FROM told WINDOW same AS (PARTITION BY t))
SELECT doc_id, keep_id, group_size, kept, sha256(t) AS text_sha256 FROM placed"""

_NAME = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
_NEVER = 1000000


def _kept(state: int) -> str:
    """What keeping a row costs in a state, by its initial."""
    ways = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})[state]
    cases = " ".join(f"WHEN init = '{i}' THEN extra + v{to}" for i, to in ways.items())
    return f"CASE WHEN fault IN (1, 2) THEN {_NEVER} {cases} ELSE {_NEVER} END"


def _renamed(state: int) -> str:
    return f"CASE WHEN fault IN (1, 2) THEN {_NEVER} ELSE extra + 1 + v{3 if state == 2 else 2} END"


def _by_state(column: str) -> str:
    return f"CASE q WHEN 0 THEN {column}0 WHEN 1 THEN {column}1 WHEN 2 THEN {column}2 ELSE {column}3 END"


# What a step keeps costs and leads to, given the state ``q`` and the initial of the row.
_KEEP_TO = "CASE WHEN init = 's' AND q = 0 THEN 1 WHEN init = 'u' AND q <> 2 THEN 2 " \
    "WHEN init = 'a' AND q = 2 THEN 3 END"
_FILL_TO = "CASE WHEN q = 2 THEN 3 ELSE 2 END"


def _after(column: str, state: str) -> str:
    return f"[{column}0, {column}1, {column}2, {column}3][1 + {state}]"


CONVERSATION_REPAIR = rf"""
WITH RECURSIVE formed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc_of(_NAME)} % 20 AS form FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN form = 4 THEN 'user' ELSE role END AS role,
              CASE form WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                        ELSE text END AS text
            FROM formed, (SELECT unnest([1, 2]) AS copy) WHERE form <> 0 AND (copy = 1 OR form = 3)),
names AS (SELECT conv_id, row_number() OVER () AS cid
          FROM (SELECT DISTINCT conv_id FROM conversations)),
placed AS (SELECT cid, turn, role, text, regexp_replace(text, '[ \t\n\x0B\f\r]+\z', '') AS ended,
             row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
             count(*) OVER (PARTITION BY cid) AS n,
             CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '-' END AS init
           FROM damaged JOIN names ON damaged.conv_id IS NOT DISTINCT FROM names.conv_id),
rows_in AS (SELECT *, CASE WHEN fault = 3 THEN 5 ELSE 0 END AS extra,
              coalesce(lag(init) OVER (PARTITION BY cid ORDER BY i) || init NOT IN ('su', 'ua', 'au'),
                       false) AS illegal
            FROM (SELECT *, CASE WHEN ended = '' THEN 1 WHEN nth > 1 THEN 2
                              WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
                  FROM (SELECT *, row_number() OVER (PARTITION BY cid, role, text ORDER BY i) AS nth
                        FROM placed))),
counts AS (SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
             count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (illegal) AS illegal,
             any_value(n) AS n FROM rows_in GROUP BY cid),
back AS (SELECT cid, n + 1 AS i, 0 AS v0, 10 AS v1, 5 AS v2, 0 AS v3 FROM counts
         UNION ALL
         SELECT cid, i, least(e0, 5 + e2, 10 + e3), least(e1, 5 + e2, 10 + e3),
                least(e2, 5 + e3), least(e3, 5 + e2)
         FROM (SELECT back.cid, rows_in.i,
                      least(2 + v0, {_kept(0)}, {_renamed(0)}) AS e0,
                      least(2 + v1, {_kept(1)}, {_renamed(1)}) AS e1,
                      least(2 + v2, {_kept(2)}, {_renamed(2)}) AS e2,
                      least(2 + v3, {_kept(3)}, {_renamed(3)}) AS e3
               FROM back JOIN rows_in ON rows_in.cid = back.cid AND rows_in.i = back.i - 1)),
steps AS (SELECT rows_in.cid, rows_in.i, init, fault, extra, role, text,
                 here.v0 AS h0, here.v1 AS h1, here.v2 AS h2, here.v3 AS h3,
                 next.v0 AS a0, next.v1 AS a1, next.v2 AS a2, next.v3 AS a3
          FROM rows_in JOIN back here ON here.cid = rows_in.cid AND here.i = rows_in.i
          JOIN back next ON next.cid = rows_in.cid AND next.i = rows_in.i + 1),
walk AS (SELECT cid, 1::BIGINT AS i, 0 AS q, n, '' AS audit, [] :: VARCHAR[] AS lines FROM counts
         UNION ALL
         SELECT cid, CASE WHEN edit = 'I' THEN i ELSE i + 1 END,
                CASE edit WHEN 'D' THEN q WHEN 'K' THEN {_KEEP_TO} ELSE {_FILL_TO} END, n,
                audit || edit,
                CASE edit WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
                  ELSE list_append(lines, CASE WHEN q = 2 THEN 'assistant:' ELSE 'user:' END
                                          || CASE edit WHEN 'R' THEN text ELSE '' END) END
         FROM (SELECT walk.*, init, role, text,
                 CASE WHEN walk.i > n THEN 'I'
                   WHEN 2 + {_by_state("a")} = {_by_state("h")} THEN 'D'
                   WHEN 5 + {_after("h", _FILL_TO)} = {_by_state("h")} THEN 'I'
                   WHEN fault IN (0, 3) AND extra + {_after("a", f"({_KEEP_TO})")} = {_by_state("h")}
                     THEN 'K' ELSE 'R' END AS edit
               FROM walk LEFT JOIN steps ON steps.cid = walk.cid AND steps.i = walk.i
               WHERE walk.i <= n OR q IN (1, 2))),
done AS (SELECT cid, audit, lines FROM walk WHERE i > n AND q IN (0, 3)),
costs AS (SELECT cid, v0 AS cost FROM back WHERE i = 1)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit,
       sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM names LEFT JOIN counts USING (cid) LEFT JOIN done USING (cid) LEFT JOIN costs USING (cid)"""

_COLUMNS = "doc_id, text, lang, source, n_chars"


def _stage(sql: str, source: str) -> str:
    return sql.replace("documents_in", source)


PIPELINE = f"""
WITH RECURSIVE {_stage(_MEASURED, "documents")},
good AS (SELECT {_COLUMNS} FROM judged WHERE kept),
{_stage(_CLASSED, "good")},
single AS (SELECT good.* FROM good JOIN classed USING (doc_id) WHERE doc_id = component_id),
{_stage(_HIT, "single")},
clean AS (SELECT {_COLUMNS} FROM hit_rows WHERE NOT contaminated),
{_stage(_MIXED, "clean")},
repeated_rows AS (SELECT {_COLUMNS} FROM (
                    SELECT {_COLUMNS}, unnest(generate_series(1, repetitions)) FROM mixed)),
{_stage(_SHARDED, "repeated_rows")}
SELECT doc_id, shard_size AS size, lang, source, shard, slot FROM sharded"""


def build() -> dict[str, str]:
    return {
        "op2_jaccard_join": JACCARD_JOIN,
        "op4_warc": WARC,
        "op6_decontamination": DECONTAMINATION,
        "op8_mixing": MIXING,
        "op9_sharding": SHARDING,
        "op10_quality_rules": QUALITY_RULES,
        "op11_merkle_manifest": MERKLE,
        "op12_exact_dedup": EXACT_DEDUP,
        "op13_conversation_repair": CONVERSATION_REPAIR,
    }
