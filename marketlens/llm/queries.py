"""The registered queries of the subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlens.llm.bpe import op2_bpe
from marketlens.llm.chat import op7_chat
from marketlens.llm.collocations import op12_collocations
from marketlens.llm.fingerprints import op10_fingerprints
from marketlens.llm.lattice import op4_lattice
from marketlens.llm.licences import op6_licences
from marketlens.llm.merkle import op11_merkle
from marketlens.llm.mixture import op5_mixture
from marketlens.llm.quality import op9_quality
from marketlens.llm.simhash import op8_simhash
from marketlens.llm.substrings import op3_substrings
from marketlens.llm.token_files import op13_token_files
from marketlens.llm.urls import op1_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_urls": op1_urls,
    "op2_bpe": op2_bpe,
    "op3_substrings": op3_substrings,
    "op4_lattice": op4_lattice,
    "op5_mixture": op5_mixture,
    "op6_licences": op6_licences,
    "op7_chat": op7_chat,
    "op8_simhash": op8_simhash,
    "op9_quality": op9_quality,
    "op10_fingerprints": op10_fingerprints,
    "op11_merkle": op11_merkle,
    "op12_collocations": op12_collocations,
    "op13_token_files": op13_token_files,
}



def _merkle_levels(name: str, depth: int) -> str:
    """CTEs of the levels of binary trees: name0 (tree, r, h) is given, n nodes in a tree."""
    told = [f"{name}n0 AS (SELECT tree, r, h, count(*) OVER (PARTITION BY tree) AS n FROM {name}0)"]
    for k in range(depth):
        told.append(
            f"{name}n{k + 1} AS MATERIALIZED (SELECT tree, r // 2 AS r, CASE WHEN any_value(n) > 1 "
            f"THEN sha256(string_agg(h, '' ORDER BY r)) ELSE any_value(h) END AS h, "
            f"(any_value(n) + 1) // 2 AS n FROM {name}n{k} AS p GROUP BY tree, p.r // 2)")
    return ", ".join(told)


def _merkle_folds(name: str, depth: int, start: str) -> str:
    """CTEs that fold each row of `start` (key, tree, r, acc, proof) up the trees."""
    told, last = [], start
    for k in range(depth):
        told.append(
            f"{name}f{k + 1} AS MATERIALIZED (SELECT key, f.tree, f.r // 2 AS r, CASE WHEN o.n = 1 "
            f"THEN acc WHEN f.r % 2 = 0 THEN sha256(acc || coalesce(s.h, '')) "
            f"ELSE sha256(s.h || acc) END AS acc, proof || coalesce(s.h, '') AS proof "
            f"FROM {last} AS f JOIN {name}n{k} AS o ON o.tree = f.tree AND o.r = f.r "
            f"LEFT JOIN {name}n{k} AS s ON s.tree = f.tree AND s.r = xor(f.r, 1))")
        last = f"{name}f{k + 1}"
    return ", ".join(told)


# Trees of up to 2**20 rows a language and 2**8 languages.
_ROWS_DEEP, _LANGS_DEEP = 20, 8


def _merkle_sql() -> str:
    def leaf(chars: str) -> str:
        told = [f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in (
            "doc_id::VARCHAR", "source", "lang", f"({chars})::VARCHAR", "text")]
        return f"sha256({' || '.join(told)})"

    # DuckDB has no crc32: the table of the polynomial, then byte by byte over the digits.
    crc = """
        RECURSIVE bits AS (SELECT i, i AS c, 0 AS k FROM range(256) t(i) UNION ALL
            SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1
            FROM bits WHERE k < 8),
        steps AS (SELECT list(c ORDER BY i) AS c FROM bits WHERE k = 8),
        sums AS (SELECT doc_id, xor(4294967295, list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''),
              lambda d: ascii(d)::BIGINT)),
            lambda s, b: xor(s >> 8, steps.c[xor(s & 255, b) + 1]::BIGINT))) AS crc
            FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), steps)"""
    return f"""WITH {crc},
        given AS (SELECT row_number() OVER () AS key, d.doc_id, coalesce('=' || lang, '') AS tree,
            {leaf('n_chars')} AS leaf, CASE WHEN crc % 7 = 0 THEN {leaf('n_chars + 1')} END
            AS tampered FROM documents AS d LEFT JOIN sums USING (doc_id)),
        placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree
            ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM given),
        a0 AS (SELECT tree, r, leaf AS h FROM placed), {_merkle_levels('a', _ROWS_DEEP)},
        tops AS MATERIALIZED (SELECT tree AS of, h, row_number() OVER (ORDER BY tree) - 1 AS r
            FROM an{_ROWS_DEEP}),
        b0 AS (SELECT '' AS tree, r, h FROM tops), {_merkle_levels('b', _LANGS_DEEP)},
        start AS (SELECT key, tree, r, coalesce(tampered, leaf) AS acc, '' AS proof FROM placed),
        {_merkle_folds('a', _ROWS_DEEP, 'start')},
        middle AS (SELECT key, '' AS tree, tops.r, acc, proof FROM af{_ROWS_DEEP} AS f
            JOIN tops ON f.tree = tops.of),
        {_merkle_folds('b', _LANGS_DEEP, 'middle')}
        SELECT doc_id, leaf, tops.h AS subroot, top.h AS root, sha256(proof) AS proof_sha256,
            acc AS folded_root, acc = top.h AS verified
        FROM placed JOIN bf{_LANGS_DEEP} AS f USING (key) JOIN tops ON placed.tree = tops.of
        CROSS JOIN bn{_LANGS_DEEP} AS top"""


# The other methods (hash functions, trained models, merges, sketches, draws) are not SQL.
ORACLES: dict[str, str] = {
    "op3_substrings": r"""
        WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(
            coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        windows AS (SELECT k, doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
            FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM d)),
        firsts AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s),
        gone AS (SELECT DISTINCT k, unnest(range(i, i + 13)) AS p
            FROM windows JOIN firsts USING (s) WHERE first < doc_id),
        words AS (SELECT k, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
        told AS (SELECT k, count(gone.p) AS n_removed,
            string_agg(x, ' ' ORDER BY p) FILTER (WHERE gone.p IS NULL) AS kept
            FROM words LEFT JOIN gone USING (k, p) GROUP BY k)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
            CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
            sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN told USING (k)""",
    "op7_chat": r"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
              (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
        e AS (SELECT *, length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) AS body,
            length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g')) AS head FROM t)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
              AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT)
              AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
              FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(head + body + 16) AS BIGINT) AS formatted_chars
            FROM e GROUP BY conv_id""",
    "op11_merkle": _merkle_sql(),
    "op12_collocations": r"""
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(
            text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        lists AS (SELECT row_number() OVER () AS k, lang,
            regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        words AS (SELECT k, lang, unnest(w) AS w, unnest(range(len(w))) AS i FROM lists),
        grams AS MATERIALIZED (SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o
            AS w3 FROM words WINDOW o AS (PARTITION BY k ORDER BY i)),
        f1 AS MATERIALIZED (SELECT lang, w1, count(*) AS a FROM grams GROUP BY ALL),
        f2 AS MATERIALIZED (SELECT lang, w1, w2, count(*) AS a FROM grams
            WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
        f3 AS MATERIALIZED (SELECT lang, w1, w2, w3, count(*) AS a FROM grams
            WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
        around AS (SELECT lang, w1, w2, max(a) AS a FROM (SELECT lang, w1, w2, a FROM f3
            UNION ALL SELECT lang, w2, w3, a FROM f3) GROUP BY ALL),
        cuts AS (SELECT p.lang, w1 || ' ' || w2 AS phrase, 1 AS k, p.a, x.a AS l, y.a AS r
            FROM f2 AS p JOIN f1 AS x USING (lang, w1) JOIN f1 AS y
              ON y.lang = p.lang AND y.w1 = p.w2
            LEFT JOIN around AS o USING (lang, w1, w2) WHERE o.a IS NULL OR 100 * o.a < 50 * p.a
            UNION ALL SELECT p.lang, concat_ws(' ', p.w1, p.w2, p.w3), 1, p.a, x.a, y.a
            FROM f3 AS p JOIN f1 AS x USING (lang, w1) JOIN f2 AS y
              ON y.lang = p.lang AND y.w1 = p.w2 AND y.w2 = p.w3
            UNION ALL SELECT p.lang, concat_ws(' ', p.w1, p.w2, p.w3), 2, p.a, x.a, y.a
            FROM f3 AS p JOIN f2 AS x USING (lang, w1, w2) JOIN f1 AS y
              ON y.lang = p.lang AND y.w1 = p.w3),
        least AS (SELECT *, 1000000::HUGEINT * a * a // (l::HUGEINT * r) AS score FROM cuts
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang
            ORDER BY score DESC, a DESC, phrase) AS rank FROM least),
        totals AS (SELECT lang, sum(a) AS n FROM f1 GROUP BY lang)
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
            FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
