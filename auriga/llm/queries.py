"""The opN_ queries over the test tables, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auriga.llm import (
    cell_clusters, chat, exact_dedup, fingerprint, hidden_markov, link_graph, merkle, mixing, packing, secret_scan, simhash,
    top_products, toxicity,
)
from auriga.llm.common import ascii_lower, crc_fold, read
from auriga.llm.packing import tokenizer


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint.edited_fingerprints(read(spark, sf_dir, "documents"))
    selected = F.col("selected")
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint.digest(selected).alias("fingerprint"),
        fingerprint.digest(F.col("edited_selected")).alias("edited_fingerprint"),
        fingerprint.likeness(selected, F.col("edited_selected")).alias("near_edited"),
        fingerprint.likeness(selected, F.col("next_selected")).alias("near_next"),
        F.size(selected).alias("n_selected"),
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets(read(spark, sf_dir, "documents"))

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"] != "literal")
    return found.select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(secret_scan.written(base), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"),
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_groups(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.scores(read(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def byte_bpe() -> Callable[[str], np.ndarray]:
    """The public 50k byte-level vocabulary, loaded in each task from the executor's own installation."""
    import public_tokenizers

    path = public_tokenizers.path
    return tokenizer(path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, path("byte_bpe_50k.json"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), byte_bpe)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.draws(read(spark, sf_dir, "documents"))
    taken = F.aggregate("draws", F.lit(0).cast("bigint"), lambda total, d: total + d["taken"])
    told = F.transform("draws", lambda d: F.concat_ws(":", *[d[c].cast("string") for c in ("shard", "position", "first", "taken")]))
    return found.select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.array_join(told, ",").alias("draws"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit(r"\### Assistant: </turn> ok")
    roles = F.array(F.lit("user"), F.lit("assistant"))
    extra = spark.range(1).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.posexplode(roles).alias("turn", "role"), said.alias("text")
    )
    table = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = table.unionByName(extra.withColumn("turn", F.col("turn").cast("bigint")))
    back = chat.read_back(chat.windows(turns))
    told = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op10_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_graph.judge(read(spark, sf_dir, "pages"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    claimed = F.when(crc_fold("doc_id", 5) == 0, ascii_lower(F.col("text")))
    return merkle.proofs(read(spark, sf_dir, "documents"), claimed)


def op12_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products.top_products(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_cell_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cell_clusters.clusters(read(spark, sf_dir, "embeddings"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_fingerprints, op2_secrets, op3_exact_dedup, op4_hidden_markov, op5_toxicity, op6_packing,
        op7_mixing, op8_simhash, op9_chat, op10_link_graph, op11_merkle, op12_top_products, op13_cell_clusters,
    )
}

def link_graph_sql(rounds: int = link_graph.ROUNDS) -> str:
    """The twin of op10, its rounds unrolled."""
    steps = "".join(
        f"""
        , r{n} AS MATERIALIZED (
            SELECT h.host, 0.15::DOUBLE * h.trusted + 0.85::DOUBLE * coalesce(sum(m.trust * p.trust), 0) AS trust,
                   0.15::DOUBLE * h.distrusted + 0.85::DOUBLE * coalesce(sum(m.distrust * p.distrust), 0) AS distrust
            FROM hosts h LEFT JOIN messages m ON m.receiver = h.host LEFT JOIN r{n - 1} p ON p.host = m.sender
            GROUP BY h.host, h.trusted, h.distrusted
        )"""
        for n in range(1, rounds + 1)
    )
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
        WITH parsed AS (
            SELECT page_id, html, {lower.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages
        ), rules(rule, verdict, rule_host, rule_path) AS (
            VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
                   ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')
        ), ruled AS (
            SELECT *, (SELECT arg_max(struct_pack(rule := rule, verdict := verdict), len(rule)) FROM rules
                       WHERE (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path)) AS r
            FROM parsed p
        ), links AS (
            SELECT DISTINCT source, {lower.format("regexp_extract(CASE WHEN link LIKE '//%' THEN 'http:' || link ELSE link END, '(?s)^.*?://([^/?#]*)', 1)")} AS target
            FROM (SELECT host AS source, unnest(regexp_extract_all(coalesce(html, ''),
                  '(?i)<a\\s[^>]*?href\\s*=\\s*["'']?((?:https?:)?//[^"''\\s>]+)', 1)) AS link FROM parsed)
        ), edges AS (
            SELECT * FROM links WHERE source <> '' AND target <> '' AND source <> target
        ), messages AS (
            SELECT source AS sender, target AS receiver, 1.0::DOUBLE / count(*) OVER (PARTITION BY source) AS trust,
                   0.0::DOUBLE AS distrust FROM edges
            UNION ALL
            SELECT target, source, 0.0::DOUBLE, 1.0::DOUBLE / count(*) OVER (PARTITION BY target) FROM edges
        ), hosts AS (
            SELECT host, max(trusted) AS trusted, max(distrusted) AS distrusted FROM (
                SELECT host, avg(CASE WHEN r.verdict = 'allow' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS trusted,
                       avg(CASE WHEN r.verdict = 'block' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS distrusted
                FROM ruled GROUP BY host
                UNION ALL SELECT receiver, 0.0::DOUBLE, 0.0::DOUBLE FROM messages
            ) GROUP BY host
        ), r0 AS MATERIALIZED (
            SELECT host, 0.15::DOUBLE * trusted AS trust, 0.15::DOUBLE * distrusted AS distrust FROM hosts
        ){steps}
        SELECT p.page_id, p.host, p.path, p.r.rule AS rule,
               coalesce(p.r.verdict, CASE WHEN s.distrust > s.trust + 0.15::DOUBLE * 0.5 THEN 'block' ELSE 'allow' END) AS verdict
        FROM ruled p JOIN r{rounds} s ON s.host = p.host
    """


def merkle_sql(levels: int = 5, fields: str = "source, lang, n_chars, text") -> str:
    """The twin of op11 for trees of up to 16 ** levels leaves: each level is a table of runs, proofs and folds are joins."""

    def field(value: str) -> str:
        return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name: str, start: str, key: str) -> str:
        """Tables name0, name1, ...: nodes by level; a tree that has one node keeps it unhashed on the levels above."""
        steps = f"{name}0 AS MATERIALIZED ({start})"
        for n in range(levels):
            steps += f""",
        {name}{n + 1} AS MATERIALIZED (
            SELECT {key}, place // 16 AS place, CASE WHEN max(many) = 1 THEN min(hash) ELSE sha256(string_agg(hash, '' ORDER BY place)) END AS hash,
                   (max(many) + 15) // 16 AS many
            FROM {name}{n} GROUP BY {key}, place // 16
        )"""
        return steps

    def beside(name: str, key: str, base: str) -> str:
        """For each row of base what stands left and right of its node on every level of the tree."""
        steps = ""
        for n in range(levels):
            last = f"{base}{n - 1}" if n else base
            match = f"m.{key} IS NOT DISTINCT FROM b.{key}" if key else "true"
            steps += f""",
        {base}{n} AS MATERIALIZED (
            SELECT b.row, any_value(b.path) || [struct_pack(
                       left_ := coalesce(string_agg(m.hash, '' ORDER BY m.place) FILTER (m.place < b.pos // {16**n}), ''),
                       right_ := coalesce(string_agg(m.hash, '' ORDER BY m.place) FILTER (m.place > b.pos // {16**n}), ''),
                       hashed := max(m.many) > 1)] AS path, any_value(b.pos) AS pos{f", any_value(b.{key}) AS {key}" if key else ""}
            FROM {last} b JOIN {name}{n} m ON {match} AND m.place // 16 = b.pos // {16 ** (n + 1)} GROUP BY b.row
        )"""
        return steps

    crc = """list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT),
                        lambda crc, byte: xor(crc >> 8, codes[(xor(crc, byte) & 255) + 1]))"""
    return f"""
        WITH crcs AS (
            SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS codes
            FROM range(256) r(i)
        ), leaves AS (
            SELECT row_number() OVER () AS row, doc_id, source, {leaf("text")} AS hash,
                   CASE WHEN text IS NOT NULL AND xor({crc}, 4294967295) % 5 = 0
                        THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS seen
            FROM documents, crcs
        ), numbered AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, hash) - 1 AS pos, count(*) OVER (PARTITION BY source) AS many
            FROM leaves
        ), {tree("s", "SELECT source, pos AS place, hash, many FROM numbered", "source")},
        tops AS (
            SELECT 0 AS every, source, hash, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS many FROM s{levels}
        ), {tree("t", "SELECT every, pos AS place, hash, many FROM tops", "every")},
        inner_ AS (SELECT row, source, pos, [] AS path FROM numbered)
        {beside("s", "source", "inner_")},
        outer_ AS (SELECT pos AS row, every, pos, [] AS path FROM tops)
        {beside("t", "every", "outer_")},
        paths AS (
            SELECT n.doc_id, n.hash AS leaf, coalesce(n.seen, n.hash) AS seen, t.hash AS subroot, (SELECT hash FROM t{levels}) AS root,
                   list_filter(i.path || o.path, lambda p: p.hashed) AS path
            FROM numbered n JOIN inner_{levels - 1} i ON i.row = n.row JOIN tops t ON t.source IS NOT DISTINCT FROM n.source
            JOIN outer_{levels - 1} o ON o.row = t.pos
        ), folded AS (
            SELECT *, list_reduce([seen] || list_transform(path, lambda p: p.left_ || ' ' || p.right_),
                                  lambda hash, p: sha256(split_part(p, ' ', 1) || hash || split_part(p, ' ', 2))) AS folded_root
            FROM paths
        )
        SELECT doc_id, leaf, subroot, root,
               sha256(coalesce(list_aggregate(list_transform(path, lambda p: p.left_ || p.right_), 'string_agg', ''), '')) AS proof_sha256,
               folded_root, folded_root = root AS verified
        FROM folded
    """


def mixing_sql(levels: int = 6, block: int = mixing.BLOCK_WORDS, shard: int = mixing.SHARD_WORDS) -> str:
    """The twin of op7 for a splitting tree of up to so many levels."""

    def keyed(*parts: str) -> str:
        return "('0x' || substr(md5('7-' || " + " || '-' || ".join(f"CAST({p} AS VARCHAR)" for p in parts) + "), 1, 13))::BIGINT"

    def let(name: str, value: str, body: str) -> str:
        return f"list_transform([{value}], lambda {name}: {body})[1]"

    def weights(name: str, steps: str, ratio: str) -> str:
        """Running products of the ratios, without the 1 they start from."""
        return (
            f"list_reduce([[1.0::DOUBLE]] || list_transform(range(1, {steps}::BIGINT + 1), lambda {name}: [{ratio}]), "
            f"lambda acc, next_: list_append(acc, acc[len(acc)] * next_[1]))[2:]"
        )

    def picked(list_: str, left: str) -> str:
        """The first weight that is larger than what is left before it."""
        lefts = f"list_reduce([[{left}]] || list_transform({list_}, lambda w: [w]), lambda acc, w: list_append(acc, acc[len(acc)] - w[1]))"
        return let("lefts", lefts, f"list_filter(range(1, len({list_}) + 1), lambda i: lefts[i] < {list_}[i])[1]")

    up = weights("i", "b.up_", "(b.k - (b.mode_ + i - 1)) * (b.m - (b.mode_ + i - 1)) / ((b.mode_ + i - 1 + 1) * (b.n - b.k - b.m + (b.mode_ + i - 1) + 1))")
    down = weights("i", "b.down_", "(b.mode_ - i + 1) * (b.n - b.k - b.m + (b.mode_ - i + 1)) / ((b.k - (b.mode_ - i + 1) + 1) * (b.m - (b.mode_ - i + 1) + 1))")
    total = "list_reduce([0.0::DOUBLE] || {}, lambda x, y: x + y)"
    settle = let("s", f"struct_pack(up_ := {total.format('w.up_')}, down_ := {total.format('w.down_')})", let(
        "left_", "b.u * (1 + s.up_ + s.down_) - 1",
        f"CASE WHEN left_ < 0 THEN b.mode_ ELSE coalesce(b.mode_ + {picked('w.up_', 'left_')}, b.mode_ - {picked('w.down_', 'left_ - s.up_')}, b.mode_) END",
    ))
    inverted = let("w", f"struct_pack(up_ := {up}, down_ := {down})", settle)
    bounded = let("a", """struct_pack(n := g.n, k := g.k, m := g.m, u := g.u, low_ := greatest(0.0, g.m - (g.n - g.k)), high_ := least(g.m, g.k),
        far_ := ceil(12 * sqrt(greatest(g.m * g.k / g.n * (g.n - g.k) / g.n * (g.n - g.m) / greatest(g.n - 1, 1.0), 0.0))) + 30)""", let(
        "a2", "struct_pack(n := a.n, k := a.k, m := a.m, u := a.u, low_ := a.low_, high_ := a.high_, far_ := a.far_, mode_ := greatest(a.low_, least(a.high_, floor((a.m + 1) * (a.k + 1) / (a.n + 2)))))",
        let("b", "struct_pack(n := a2.n, k := a2.k, m := a2.m, u := a2.u, mode_ := a2.mode_, up_ := least(a2.high_, a2.mode_ + a2.far_) - a2.mode_, down_ := a2.mode_ - greatest(a2.low_, a2.mode_ - a2.far_))", inverted),
    ))
    drawn = f"""CASE WHEN e.quota = 0 OR e.want = 0 THEN 0 WHEN e.want = e.rest THEN e.quota ELSE CAST({let(
        "g", "struct_pack(n := e.rest::DOUBLE, k := e.quota::DOUBLE, m := e.want::DOUBLE, u := e.u)", bounded)} AS BIGINT) END"""
    tree = ""
    for level in range(levels):
        tree += f""", w{level} AS (
            SELECT node, 0 AS number, sum(quota)::BIGINT AS rest, (sum(quota)::BIGINT + {keyed(str(level), "node")} % 2) // 2 AS want, 0::BIGINT AS x
            FROM n{level} GROUP BY node
            UNION ALL
            SELECT node, number, rest - quota, want - x, x FROM (
                SELECT e.*, {drawn} AS x FROM (
                    SELECT n.node, n.number, n.quota, w.rest, w.want, {keyed(str(level), "n.node", "n.number - 1")} * (1.0::DOUBLE / 4503599627370496) AS u
                    FROM w{level} w JOIN n{level} n ON n.node = w.node AND n.number = w.number + 1
                ) e
            )
        ), n{level + 1} AS MATERIALIZED (
            SELECT n.node * 2 + side AS node, n.number, CASE side WHEN 0 THEN w.x ELSE n.quota - w.x END AS quota
            FROM n{level} n JOIN w{level} w USING (node, number), range(2) r(side) WHERE (SELECT depth FROM plan) > {level}
            UNION ALL
            SELECT node, number, quota FROM n{level} WHERE (SELECT depth FROM plan) <= {level}
        )"""
    return f"""
        WITH RECURSIVE sized AS (
            SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
                   md5('7-' || coalesce(CAST(doc_id AS VARCHAR), '') || '-' || md5(coalesce(text, ''))) AS place
            FROM documents
        ), per AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS number
            FROM sized GROUP BY source
        ), levels AS (
            SELECT *, [3, 1, 2][(number - 1) % 3 + 1] AS weight FROM per
        ), shares AS (
            SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS BIGINT)
                       - coalesce(sum(2 * source_size) OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
                      / (sum(weight) OVER (b ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
            FROM levels WINDOW b AS (ORDER BY 2 * source_size / weight::DOUBLE, number)
        ), aims AS MATERIALIZED (
            SELECT source, number, source_size, target, drawn, (drawn + {block - 1}) // {block} AS blocks FROM (
                SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS drawn FROM (
                    SELECT source, number, source_size, least((2 * source_size)::DOUBLE, max(level) OVER () * weight) AS target FROM shares
                )
            )
        ), plan AS MATERIALIZED (
            SELECT greatest(0, ceil(log2(greatest(1, CAST(floor(1.5 * sum(source_size)) AS BIGINT)) / {float(shard)}::DOUBLE))) AS depth FROM aims
        ), n0 AS MATERIALIZED (SELECT 0::BIGINT AS node, number, blocks AS quota FROM aims){tree}, spans AS (
            SELECT node AS shard, number, quota, sum(quota) OVER (PARTITION BY number ORDER BY node) AS stop FROM n{levels}
        ), listed AS (
            SELECT number, blocks, unnest(range(blocks)) AS block FROM aims
        ), ranked AS (
            SELECT number, block, list_reduce([block] || range(1, {mixing.ROUNDS + 1}), lambda x, r: {let(
                "y", f"((({keyed('r', 'number')} % blocks) - x) % blocks + blocks) % blocks",
                f"CASE WHEN {keyed('r', 'number', 'greatest(x, y)')} % 2 = 1 THEN y ELSE x END")}) AS rank
            FROM listed
        ), dealt AS MATERIALIZED (
            SELECT r.number, r.block, s.shard FROM ranked r JOIN spans s ON s.number = r.number AND r.rank >= s.stop - s.quota AND r.rank < s.stop
        ), placed AS (
            SELECT s.doc_id, s.size, a.source_size, a.target, a.drawn, a.number,
                   CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.doc_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
            FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source
        ), epochs AS (
            SELECT *, start + epoch * source_size AS at_, least(start + epoch * source_size + size, drawn) AS end_ FROM placed, range(2) e(epoch)
        ), pieces AS (
            SELECT *, unnest(range(at_ // {block}, (end_ - 1) // {block} + 1)) AS block FROM epochs WHERE end_ > at_
        ), cut AS (
            SELECT p.doc_id, p.number, p.start, p.epoch, d.shard, greatest(at_, p.block * {block}) - at_ AS first_,
                   least(end_, (p.block + 1) * {block}) - greatest(at_, p.block * {block}) AS taken
            FROM pieces p JOIN dealt d ON d.number = p.number AND d.block = p.block
        ), shuffled AS (
            SELECT *, row_number() OVER (PARTITION BY shard ORDER BY md5('7-' || coalesce(doc_id || '-', '') || epoch || '-' || start || '-' || first_),
                                         number, start, epoch, first_) AS position FROM cut
        ), told AS (
            SELECT number, start, sum(taken)::BIGINT AS taken,
                   string_agg(shard || ':' || position || ':' || first_ || ':' || taken, ',' ORDER BY epoch, first_) AS draws
            FROM shuffled GROUP BY number, start
        )
        SELECT p.doc_id, p.size, p.source_size, p.target, coalesce(t.taken, 0) AS taken, coalesce(t.draws, '') AS draws
        FROM placed p LEFT JOIN told t ON t.number = p.number AND t.start = p.start AND p.size > 0
    """


WHOLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def cell_clusters_sql(rounds: int = 3) -> str:
    """The twin of op13, its rounds unrolled, over one row per vector and component."""

    def assigned(centers: str) -> str:
        return f"""
            SELECT v.row, arg_min(struct_pack(cluster := c.cluster, distance := c.distance), c.distance * 64 + c.cluster) AS best
            FROM vectors v JOIN (
                SELECT p.row, c.cluster, CAST(sum((p.x - c.x) * (p.x - c.x)) AS BIGINT) AS distance
                FROM parts p JOIN {centers} c USING (dim) GROUP BY p.row, c.cluster
            ) c USING (row) GROUP BY v.row"""

    steps = ""
    for n in range(rounds):
        steps += f""", a{n} AS MATERIALIZED ({assigned(f"c{n}")}
        ), m{n} AS MATERIALIZED (
            SELECT a.best.cluster AS cluster, p.dim, CAST(sum(p.x) AS BIGINT) AS total, count(*) AS many
            FROM a{n} a JOIN parts p USING (row) GROUP BY a.best.cluster, p.dim
        ), c{n + 1} AS MATERIALIZED (
            SELECT c.cluster, c.dim, coalesce((m.total - ((m.total % m.many) + m.many) % m.many) // m.many, c.x) AS x
            FROM c{n} c LEFT JOIN m{n} m USING (cluster, dim)
        )"""
    return f"""
        WITH vectors AS MATERIALIZED (
            SELECT row_number() OVER () AS row, vec_id,
                   list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints,
                   sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS name
            FROM embeddings WHERE {WHOLE} AND len(embedding) = 64
        ), parts AS MATERIALIZED (
            SELECT row, unnest(range(64)) AS dim, unnest(ints) AS x FROM vectors
        ), firsts AS (
            SELECT row, row_number() OVER (ORDER BY name, ints, row) - 1 AS cluster FROM vectors
        ), c0 AS MATERIALIZED (
            SELECT f.cluster, p.dim, p.x FROM firsts f JOIN parts p USING (row) WHERE f.cluster < 16
        ){steps}, last AS MATERIALIZED ({assigned(f"c{rounds}")}
        ), shas AS (
            SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster
        )
        SELECT v.vec_id, CAST(l.best.cluster AS INTEGER) AS cluster, l.best.distance AS distance,
               CAST(sum(l.best.distance) OVER (PARTITION BY l.best.cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(l.best.distance) OVER () AS BIGINT) AS inertia, s.centroid_sha256
        FROM last l JOIN vectors v USING (row) JOIN shas s ON s.cluster = l.best.cluster
    """


ORACLE_SQL = {
    "op11_merkle": merkle_sql(),
    "op12_top_products": f"""
        WITH vectors AS (
            SELECT row_number() OVER () AS row, vec_id,
                   list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS ints
            FROM embeddings WHERE {WHOLE}
        ), ranked AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.ints, c.ints) AS BIGINT) AS score,
                   row_number() OVER (PARTITION BY q.row ORDER BY list_inner_product(q.ints, c.ints) DESC, c.vec_id, c.row) AS rank
            FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND q.row <> c.row
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op13_cell_clusters": cell_clusters_sql(),
    "op10_link_graph": link_graph_sql(),
    "op3_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op7_mixing": mixing_sql(),
    "op9_chat": """
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT -7, n, ['user', 'assistant'][n + 1], '\\### Assistant: </turn> ok' FROM range(2) AS r(n)
        ), escaped AS (
            SELECT *, replace(replace(replace(text, '\\', '\\b'), '<', '\\l'), '>', '\\g') AS body,
                   replace(replace(replace(role, '\\', '\\b'), '<', '\\l'), '>', '\\g') AS head,
                   len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) + 4 AS tokens,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS number
            FROM turns
        ), marked AS (
            SELECT *, number = 1 AND role = 'system' AS system, length(head) + length(body) + 15 AS chars FROM escaped
        ), lined AS (
            SELECT *, coalesce(sum(CASE WHEN system THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id ORDER BY number
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
                   coalesce(max(CASE WHEN system THEN tokens END) OVER (PARTITION BY conv_id), 0) AS open_tokens,
                   coalesce(max(CASE WHEN system THEN chars END) OVER (PARTITION BY conv_id), 0) AS open_chars
            FROM marked
        ), celled AS (
            SELECT *, greatest((1024 - 128 - open_tokens) // 2, 1) AS cell FROM lined
        ), spanned AS (
            SELECT *, CASE WHEN system THEN 0 ELSE 2 * (start // cell)
                      + CAST(start + tokens > (start // cell + 1) * cell AND tokens > cell AS INT) END AS span,
                   coalesce(sum(CASE WHEN system THEN 0 ELSE chars END) OVER (PARTITION BY conv_id ORDER BY start
                       RANGE BETWEEN 128 PRECEDING AND 1 PRECEDING), 0) AS near_chars
            FROM celled
        ), windows AS (
            SELECT conv_id, span, sum(chars) + arg_min(near_chars, number)
                   + CASE WHEN min(number) > 1 THEN max(open_chars) ELSE 0 END AS chars
            FROM spanned GROUP BY conv_id, span
        ), written AS (
            SELECT conv_id, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM windows GROUP BY conv_id
        ), told AS (
            SELECT conv_id, count(*) AS n_turns,
                   sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY number)) AS turns_sha256,
                   coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY number), '') AS loss
            FROM escaped GROUP BY conv_id
        )
        SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
        FROM told JOIN written USING (conv_id)
    """,
}
