"""SQL building blocks of the twins: the derived views of FIXTURES.md in plain SQL."""

from __future__ import annotations

from conceptlink.functions.text import PUNCTUATION, STOPWORDS, TOKEN_PATTERN


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


STOP = ", ".join(quoted(w) for w in STOPWORDS)
PUNCT = quoted(PUNCTUATION)

VIEWS = {
    "tok": f"""
        SELECT doc_id, pos, lower(raw) AS token FROM (
          SELECT doc_id, unnest(m) AS raw, unnest(range(len(m))) AS pos
          FROM (SELECT doc_id, regexp_extract_all(text, '{TOKEN_PATTERN}') AS m FROM documents))""",
    "words": f"""
        SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS pos, token
        FROM tok WHERE token NOT IN ({STOP}) AND instr({PUNCT}, token) = 0""",
    "wv": """
        SELECT token, vec_id, embedding AS vec FROM (
          SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) - 1 AS place FROM tok GROUP BY token) r
        JOIN embeddings e ON e.vec_id = r.place""",
    "wvd": """
        SELECT token, unnest(range(len(vec))) AS dim, CAST(unnest(vec) AS DOUBLE) AS v FROM wv""",
    "kw": """
        SELECT doc_id, token AS concept, place - 1 AS pos FROM (
          SELECT doc_id, token, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, token) AS place
          FROM tok WHERE regexp_matches(token, '^[a-z]+$') AND length(token) >= 4 GROUP BY doc_id, token)
        WHERE place <= 6""",
    "uni": """
        SELECT concept, row_number() OVER (ORDER BY concept) - 1 AS idx FROM (SELECT DISTINCT concept FROM kw)""",
    "counts": """
        SELECT doc_id, token, count(*) AS n FROM words GROUP BY doc_id, token""",
    "dv": """
        SELECT d.doc_id, d.dim, coalesce(s.total / s.hits, 0.0) AS v FROM (
          SELECT doc_id, dim FROM documents, (SELECT unnest(range(max(len(embedding)))) AS dim FROM embeddings)) d
        LEFT JOIN (SELECT doc_id, dim, sum(n * v) AS total, sum(n) AS hits
                   FROM counts JOIN wvd USING (token) GROUP BY doc_id, dim) s
        ON s.doc_id = d.doc_id AND s.dim = d.dim""",
    "pts": """
        SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label, CAST(vec_id % 7 AS INTEGER) AS cluster_id
        FROM embeddings""",
    "ptd": """
        SELECT id, label, cluster_id, unnest(range(len(vec))) AS dim, unnest(vec) AS v FROM pts""",
    "sc": """
        SELECT l.doc_id, l.quality AS label, CAST(d.n_chars AS DOUBLE) AS score
        FROM labels l JOIN documents d ON d.doc_id = l.doc_id""",
}

NEEDS = {
    "words": ["tok"],
    "wv": ["tok"],
    "wvd": ["wv"],
    "kw": ["tok"],
    "uni": ["kw"],
    "counts": ["words"],
    "dv": ["counts", "wvd"],
    "ptd": ["pts"],
}


def with_views(*names: str, extra: dict[str, str] | None = None, body: str) -> str:
    """A query over the named views; ``extra`` adds views of its own, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in ordered]
    parts += [f"{n} AS MATERIALIZED ({sql})" for n, sql in (extra or {}).items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def tidy(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0"


def hash_key(seed: int, *cols: str) -> str:
    return "md5(concat_ws('|', '" + str(seed) + "', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in cols) + "))"


def hash_draw(key: str) -> str:
    return f"CAST('0x' || substr({key}, 1, 13) AS BIGINT)"


def hash_below(key: str, share: float) -> str:
    return f"{hash_draw(key)} < {int(share * 16 ** 13)}"
