"""The registered queries of this folder, one for each operator, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwright.llm.automaton import encoded
from claimwright.llm.common import crc_bucket, folder, ship, table
from claimwright.llm.exact import exact_duplicates
from claimwright.llm.language import languages
from claimwright.llm.merkle import manifest, proof_digest
from claimwright.llm.mixing import mixed
from claimwright.llm.neighbours import nearest
from claimwright.llm.preferences import swapped_pairs
from claimwright.llm.quality import quality
from claimwright.llm.records import write_and_read
from claimwright.llm.repeats import without_repeats
from claimwright.llm.simhash import near_duplicates
from claimwright.llm.token_counts import token_counts
from claimwright.llm.whitening import whitened

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str):
    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        return function

    return register


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), limit=2048)


@query("op9_automaton")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), keep_ids=False)


@query("op2_binary_records")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs, path = table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json")
    found = write_and_read(spark, docs, folder(spark, "records"), path, public_tokenizers.PATTERN, end_id=0)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op4_exact_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op4_exact_dedup"] = """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query("op10_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixed(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.0, most=3.0, seed="mix")
    return found.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op10_mixing"] = r"""
    WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
            (('0x' || substr(md5('mix/' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
        FROM documents
    ), sources AS (
        SELECT source, sum(size)::BIGINT AS source_size, sum(size)::DOUBLE * 3.0 AS cap,
            ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INTEGER]::DOUBLE AS weight
        FROM sized GROUP BY source
    ), levels AS (
        SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM sources WINDOW r AS (ORDER BY cap / weight, source IS NULL, source)
    ), goals AS (
        SELECT source, source_size, least(cap, coalesce(max(level) FILTER (level * weight <= cap) OVER () * weight, cap)) AS target
        FROM levels
    ), included AS (
        SELECT d.*, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN least(g.target / g.source_size, 3.0) ELSE 0.0 END AS inclusion
        FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
    ), parts AS (
        SELECT *, floor(inclusion)::BIGINT AS certain, inclusion - floor(inclusion) AS p FROM included
    ), ranked AS (
        SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS odds, target - sum(certain * size) OVER (PARTITION BY source) AS wanted
        FROM parts
    ), running AS (
        SELECT *, odds / (1 + odds) AS rank,
            sum(size) OVER (PARTITION BY source ORDER BY odds / (1 + odds), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
        FROM ranked
    ), cuts AS (
        SELECT source, min(upto - size) AS fits, min({'rank': rank, 'doc_id': doc_id}) AS place
        FROM running WHERE rank IS NOT NULL AND upto > wanted GROUP BY source
    ), sampled AS (
        SELECT r.*, c.fits, c.source IS NOT NULL OR c.fits IS NOT NULL AS has_cut,
            r.rank IS NOT NULL AND (c.place IS NULL OR {'rank': r.rank, 'doc_id': r.doc_id} < c.place) AS inside
        FROM running r LEFT JOIN cuts c ON r.source IS NOT DISTINCT FROM c.source
    ), closing AS (
        SELECT source, arg_min(doc_id, {'gap': abs(size - (wanted - fits)), 'rank': rank, 'doc_id': doc_id}) AS doc_id
        FROM sampled WHERE rank IS NOT NULL AND NOT inside AND fits IS NOT NULL AND abs(size - (wanted - fits)) < wanted - fits GROUP BY source
    )
    SELECT s.doc_id, s.size, s.source_size, s.target,
        (s.size * (s.certain + (s.inside OR c.doc_id IS NOT NULL)::INTEGER))::BIGINT AS taken
    FROM sampled s LEFT JOIN closing c ON s.source IS NOT DISTINCT FROM c.source AND s.doc_id = c.doc_id
"""


@query("op3_simhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, most=3)


@query("op5_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_preferences")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = swapped_pairs(table(spark, sf_dir, "conversations"))
    listed = {c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias(c) for c in ("chosen_mask", "rejected_mask")}
    return found.select("pair_id", "n_common", "prompt", "chosen", "rejected", *listed.values())


ORACLES["op6_preferences"] = """
    WITH replies AS (
        SELECT conv_id, max(turn) FILTER (role = 'assistant') AS last FROM conversations GROUP BY conv_id
    ), said AS (
        SELECT c.conv_id, max(c.text) AS reply FROM conversations c JOIN replies r USING (conv_id)
        WHERE c.turn = r.last AND c.role = 'assistant' GROUP BY c.conv_id
    ), sides AS (
        SELECT conv_id AS pair_id, 'c' AS side, turn, role, text FROM conversations JOIN replies USING (conv_id) WHERE last IS NULL OR turn <= last
        UNION ALL
        SELECT conv_id, 'r', turn, role, text FROM conversations JOIN replies USING (conv_id) WHERE last IS NULL OR turn < last
        UNION ALL
        SELECT r.conv_id, 'r', r.last, 'assistant', s.reply FROM replies r JOIN said s ON s.conv_id = xor(r.conv_id, 1) WHERE r.last IS NOT NULL
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn, role, text) AS pos, length('<|im_start|>' || role || chr(10)) AS head,
            '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS shown
        FROM sides
    ), differ AS (
        SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.pos, r.pos) AS pos,
            c.pos IS NULL OR r.pos IS NULL OR c.role <> r.role OR c.text <> r.text AS other
        FROM (FROM placed WHERE side = 'c') c FULL JOIN (FROM placed WHERE side = 'r') r ON c.pair_id = r.pair_id AND c.pos = r.pos
    ), common AS (
        SELECT pair_id, coalesce(min(pos) FILTER (other) - 1, max(pos))::INTEGER AS n_common FROM differ GROUP BY pair_id
    ), after AS (
        SELECT p.*, sum(length(shown)) OVER (PARTITION BY p.pair_id, side ORDER BY pos) - length(shown) AS begins
        FROM placed p JOIN common USING (pair_id) WHERE pos > n_common
    ), parts AS (
        SELECT pair_id, string_agg(shown, '' ORDER BY pos) FILTER (side = 'c') AS c, string_agg(shown, '' ORDER BY pos) FILTER (side = 'r') AS r,
            string_agg((begins + head)::VARCHAR || '-' || (begins + length(shown))::VARCHAR, ',' ORDER BY pos) FILTER (side = 'c' AND role = 'assistant') AS cm,
            string_agg((begins + head)::VARCHAR || '-' || (begins + length(shown))::VARCHAR, ',' ORDER BY pos) FILTER (side = 'r' AND role = 'assistant') AS rm
        FROM after GROUP BY pair_id
    ), prompts AS (
        SELECT pair_id, string_agg(shown, '' ORDER BY pos) AS prompt FROM placed JOIN common USING (pair_id) WHERE side = 'c' AND pos <= n_common GROUP BY pair_id
    )
    SELECT pair_id, n_common, coalesce(prompt, '') AS prompt, coalesce(c, '') AS chosen, coalesce(r, '') AS rejected,
        coalesce(cm, '') AS chosen_mask, coalesce(rm, '') AS rejected_mask
    FROM common LEFT JOIN prompts USING (pair_id) LEFT JOIN parts USING (pair_id)
"""


@query("op7_prefix_forest")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0, k=5)


@query("op8_language")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"), components=8)


@query("op12_substrings")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), window=20, keep_text=False)


ORACLES["op12_substrings"] = r"""
    WITH docs AS MATERIALIZED (
        SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
    ), places AS (
        SELECT rid, doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos, len(words) AS n FROM docs
    ), windows AS (
        SELECT *, CASE WHEN pos + 19 <= n THEN string_agg(word, ' ') OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) END AS said FROM places
    ), firsts AS (
        SELECT said, min({'doc_id': doc_id, 'pos': pos}) AS place FROM windows WHERE said IS NOT NULL GROUP BY said
    ), repeats AS (
        SELECT w.rid, w.pos, w.word, coalesce({'doc_id': w.doc_id, 'pos': w.pos} > f.place, false) AS lost FROM windows w LEFT JOIN firsts f USING (said)
    ), covered AS (
        SELECT *, bool_or(lost) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM repeats
    ), left_over AS (
        SELECT rid, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone), '') AS kept FROM covered GROUP BY rid
    )
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM docs LEFT JOIN left_over USING (rid)
"""


@query("op13_merkle")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(crc_bucket("doc_id", 2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = manifest(table(spark, sf_dir, "documents"), found={"text": tampered})
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified")


def _merkle_sql(levels: int = 12) -> str:
    """Levels are spelled out: enough for 3 ** levels leaves of a source, and as many sources. ``path``: siblings on the
    left and right of each step."""

    def field(c: str) -> str:
        return f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name: str, start: str, group: str, order: str) -> str:
        steps = [f"{name}0 AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {order}) - 1 AS pos, count(*) OVER (PARTITION BY {group}) AS n, h AS node, "
                 f"[]::STRUCT(l VARCHAR, r VARCHAR)[] AS path FROM {start})"]
        for i in range(levels):
            # One row per leaf throughout: those under one node share its position.
            steps.append(
                f"{name}{i}n AS (SELECT DISTINCT {group}, pos, n, node FROM {name}{i}), "
                f"{name}{i}r AS (SELECT {group} AS g, pos // 3 AS run, list(node ORDER BY pos) AS nodes FROM {name}{i}n GROUP BY ALL), "
                f"{name}{i + 1} AS (SELECT t.* EXCLUDE (pos, n, node, path), pos // 3 AS pos, (n + 2) // 3 AS n, "
                f"CASE WHEN n > 1 THEN sha256(array_to_string(nodes, '')) ELSE node END AS node, "
                f"CASE WHEN n > 1 THEN list_append(path, {{'l': array_to_string(nodes[:pos % 3], ''), 'r': array_to_string(nodes[pos % 3 + 2:], '')}}) ELSE path END AS path "
                f"FROM {name}{i} t JOIN {name}{i}r ON g IS NOT DISTINCT FROM {group} AND run = pos // 3)")
        return ", ".join(steps)

    crc = ("list_reduce(list_prepend(4294967295::BIGINT, list_transform(str_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), "
           "lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)))")
    return f"""
    WITH leaves AS (
        SELECT doc_id, source, {leaf("text")} AS h, CASE WHEN doc_id IS NOT NULL AND xor({crc}, 4294967295) % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS met
        FROM documents
    ), {tree("t", "leaves", "source", "doc_id NULLS FIRST, h")},
    tops AS (SELECT DISTINCT source, node AS h, 1 AS one FROM t{levels}),
    {tree("s", "tops", "one", "source NULLS FIRST")},
    whole AS (
        SELECT t.doc_id, t.h AS leaf, t.met, t.node AS subroot, s.node AS root, list_concat(t.path, s.path) AS path
        FROM t{levels} t JOIN s{levels} s ON t.source IS NOT DISTINCT FROM s.source
    ), folds AS (
        SELECT *, (list_reduce(list_prepend({{'l': met, 'r': ''}}, path), lambda a, s: {{'l': sha256(s.l || a.l || s.r), 'r': ''}})).l AS folded_root FROM whole
    )
    SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.l || s.r), '')) AS proof_sha256, folded_root, folded_root = root AS verified
    FROM folds
    """


ORACLES["op13_merkle"] = _merkle_sql()
