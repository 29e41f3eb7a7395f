"""Documents and retrieval (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from auriga.operators import documents, retrieval
from auriga.operators.audit_rules import RULES
from auriga.operators.documents import BLANKS, ENTITIES, HIDDEN, TAG, TITLE, WORD
from auriga.plans.oracle_tables import rnd

VECTOR_SIZE = 64
POLICIES = sorted({rule[-1] for rule in RULES})
_NAMED = " ".join(f"WHEN 'src{i}' THEN '{name}'" for i, name in enumerate(POLICIES))


def _readable(expr: str) -> str:
    out = f"regexp_replace({expr}, '{TAG}', ' ', 'g')"
    for entity, char in ENTITIES.items():
        out = f"replace({out}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return f"trim(regexp_replace({out}, '{BLANKS}', ' ', 'g'))"


def _visible() -> str:
    out = "html"
    for pattern in [*HIDDEN, TITLE]:
        out = f"regexp_replace({out}, '{pattern}', ' ', 'g')"
    return out


def _sections(marker: str) -> str:
    heading = marker.lstrip("\n").replace("'", "''")
    quoted = "chr(10) || '" + heading + "'"
    return f"""
    SELECT doc_nome || '#' || i AS chunk_id, doc_nome, politica, CAST(i AS INT) AS secao_idx,
           CASE WHEN i = 0 THEN p ELSE '{heading}' || p END AS texto
    FROM (SELECT doc_nome, politica, unnest(s) AS p, unnest(range(len(s))) AS i
          FROM (SELECT *, string_split(texto, {quoted}) AS s FROM t_docs)) WHERE length(trim(p)) > 0"""


EXTRA = {
    "t_docs": f"""SELECT 'doc-' || doc_id AS doc_nome, CASE source {_NAMED} ELSE source END AS politica,
        text AS texto FROM documents""",
    "t_chunks": _sections("\n"),
    "t_bags": f"""SELECT chunk_id, regexp_extract_all(lower(texto), '{WORD}') AS w FROM t_chunks""",
    "t_words": "SELECT chunk_id, w, count(*) AS tf FROM (SELECT chunk_id, unnest(w) AS w FROM t_bags) GROUP BY ALL",
    "t_asked": f"""SELECT DISTINCT item_id AS id_consulta, unnest(regexp_extract_all(lower(text), '{WORD}')) AS w
        FROM benchmark""",
    "t_idf": """SELECT w, ln(1 + (n - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS idf
        FROM t_words, (SELECT count(*) AS n FROM t_bags) GROUP BY w, n""",
    "t_scores": f"""SELECT id_consulta, chunk_id,
               {rnd('sum(idf * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len(b.w) / media)))', 6)} AS score
        FROM t_asked JOIN t_words USING (w) JOIN t_idf USING (w) JOIN t_bags b USING (chunk_id),
             (SELECT avg(len(w)) AS media FROM t_bags)
        GROUP BY ALL""",
    "t_hits": """SELECT id_consulta, row_number() OVER (PARTITION BY id_consulta ORDER BY score DESC, chunk_id) AS posicao,
               chunk_id, score FROM t_scores QUALIFY posicao <= 4""",
    "t_middles": """SELECT label AS id_consulta, list(m ORDER BY i) AS vetor
        FROM (SELECT label, i, avg(CAST(v AS DOUBLE)) AS m
              FROM (SELECT label, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM embeddings)
              GROUP BY ALL) GROUP BY label""",
}


def register(add_query) -> None:
    def add(name, build, sql=None):
        add_query(name, build, sql, **EXTRA)

    add("c1_line_sections", lambda c: c.chunks, "SELECT * FROM t_chunks")
    add("c1_heading_sections", lambda c: documents.split_sections(c.lake.documents()), _sections("\n## "))
    add(
        "c2_page_text",
        lambda c: documents.page_text(c.lake.table("pages")),
        f"""SELECT page_id, url, {_readable(f"regexp_extract(html, '{TITLE}', 1)")} AS titulo,
                   {_readable(_visible())} AS texto FROM pages""",
    )
    add(
        "c3_bounded_chunks",
        lambda c: documents.bounded_chunks(c.lake.documents()),
        f"""SELECT doc_nome || '#' || i AS chunk_id, doc_nome, CAST(i AS INT) AS parte_idx,
                   CAST(len(p) AS INT) AS n_tokens, array_to_string(p, ' ') AS texto
            FROM (SELECT doc_nome, i, w[i * tam + 1:(i + 1) * tam] AS p
                  FROM (SELECT *, unnest(range(partes)) AS i
                        FROM (SELECT *, CAST(ceil(len(w) / partes) AS BIGINT) AS tam
                              FROM (SELECT *, CAST(ceil(len(w) / 1000) AS BIGINT) AS partes
                                    FROM (SELECT doc_nome, list_filter(string_split_regex(texto, '{BLANKS}'),
                                                                       lambda x: x <> '') AS w FROM t_docs)
                                    WHERE len(w) > 0))))
            WHERE len(p) > 0""",
    )
    add(
        "c4_chunk_check",
        lambda c: documents.check_chunks(c.chunks),
        """SELECT doc_nome, count(*) AS qtd_chunks, count(*) FILTER (WHERE length(trim(texto)) = 0) AS qtd_vazios
           FROM t_chunks GROUP BY 1""",
    )
    add(
        "c5_semantic_top_k",
        lambda c: retrieval.semantic_top_k(_middles(c), c.lake.vectors()),
        f"""SELECT id_consulta, row_number() OVER (PARTITION BY id_consulta ORDER BY score DESC, id) AS posicao, id, score
            FROM (SELECT id_consulta, vec_id AS id,
                         {rnd('list_cosine_similarity(vetor, CAST(embedding AS DOUBLE[]))', 6)} AS score
                  FROM t_middles, embeddings) QUALIFY posicao <= 4""",
    )
    add("c5_approximate_top_k", lambda c: retrieval.approximate_top_k(_middles(c), c.lake.vectors()))
    add(
        "c5_approximate_check",
        lambda c: _approximate_check(c).select((F.col("recall") >= 0.9).alias("recall_ok"), "scores_equal"),
        "SELECT true AS recall_ok, true AS scores_equal",
    )
    add("c6_lexical_top_k", lambda c: c.lexical_hits, "SELECT * FROM t_hits")
    add(
        "c7_contexts",
        lambda c: retrieval.contexts(c.lexical_hits, c.chunks),
        """SELECT id_consulta, string_agg('[' || doc_nome || '] ' || texto, chr(10) || chr(10) ORDER BY posicao)
             AS contexto FROM t_hits JOIN t_chunks USING (chunk_id) GROUP BY 1""",
    )
    add(
        "c8_rule_policies",
        lambda c: documents.rule_policies(c.rules, c.chunks),
        """SELECT id_regra, regra_nome, t.* FROM t_rules JOIN t_chunks t ON politica = politica_referencia""",
    )


def _approximate_check(c):
    middles, vectors = _middles(c), c.lake.vectors()
    return retrieval.recall(retrieval.approximate_top_k(middles, vectors), retrieval.semantic_top_k(middles, vectors))


def _middles(c):
    return retrieval.label_centers(c.lake.vectors(), VECTOR_SIZE).select(F.col("label").alias("id_consulta"), "vetor")
