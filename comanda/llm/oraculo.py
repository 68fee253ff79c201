"""DuckDB SQL that gives the rows of the text queries, written apart from their method."""

from __future__ import annotations

from comanda.llm import chat, descontaminacion, licencias, reglas
from comanda.llm.comun import MAYUSCULAS, MINUSCULAS, NO_BLANCO, PALABRA


def _lista(texto: str, patron: str) -> str:
    return f"regexp_extract_all(translate(coalesce({texto}, ''), '{MAYUSCULAS}', '{MINUSCULAS}'), '{patron}')"


def contaminacion(docs: str = "documents") -> str:
    """Every benchmark window against every stretch of as many words in every document."""
    v = descontaminacion.VENTANA
    return f"""WITH d AS (SELECT doc_id, {_lista('text', PALABRA)} AS w FROM {docs}),
i AS (SELECT item_id, {_lista('text', PALABRA)} AS w FROM benchmark WHERE text IS NOT NULL),
v AS (SELECT DISTINCT item_id, least({v}, len(w)) AS m, w[s : s + least({v}, len(w)) - 1] AS t
      FROM i, unnest(range(1, len(w) - least({v}, len(w)) + 2)) u(s) WHERE len(w) > 0),
p AS (SELECT doc_id, s, m, w[s : s + m - 1] AS t
      FROM d, (SELECT DISTINCT m FROM v) x, unnest(range(1, len(w) - m + 2)) u(s)),
h AS (SELECT doc_id, s, p.m, item_id FROM p JOIN v USING (m, t)),
n AS (SELECT doc_id, count(DISTINCT q) AS n FROM h, unnest(range(s, s + m)) u(q) GROUP BY doc_id),
e AS (SELECT doc_id, count(*) AS k, string_agg(c, ',' ORDER BY c) AS t
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS c FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_hit, coalesce(k, 0) AS n_items,
       sha256(coalesce(t, '')) AS items_sha256, coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN e USING (doc_id)"""


def _licencias() -> str:
    lugares = " || ".join(
        "list_filter(range(0, len(w)), lambda i: " + " AND ".join(
            f"w[i + {k + 1}] = '{p}'" for k, p in enumerate(frase.split())) + ")"
        for frase in licencias.FRASES)
    base = ", ".join(
        f"CASE WHEN len(list_filter(range(0, len(w)), lambda i: " + " AND ".join(
            f"w[i + {k + 1}] = '{p}'" for k, p in enumerate(frase.split())) + f")) > 0 THEN '{etiqueta}' END"
        for frase, etiqueta in licencias.FRASES.items())
    propias = ", ".join(f"CASE WHEN regexp_matches(t, '{licencias.expresion(x)}') THEN '{n}' END"
                        for n, x in licencias.PLANTILLAS.items())
    junta = "array_to_string(list_sort(list_distinct(list_filter({}, lambda x: x IS NOT NULL))), ',')"
    return f"""WITH d AS (SELECT doc_id, {_lista('text', PALABRA)} AS w FROM documents),
e AS (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS t, {lugares} AS l, [{base}] AS b FROM d),
f AS (SELECT *, [{propias}] AS p FROM e)
SELECT doc_id, len(w) AS n_words, len(l) AS n_base, list_min(l) AS first_word, list_max(l) AS last_word,
       {junta.format('b')} AS base_labels, {junta.format('b || p')} AS labels,
       CASE WHEN len(list_filter(p, lambda x: x IS NOT NULL)) > 0 THEN 1.0 WHEN len(l) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE
           AS score
FROM f"""


def calidad(docs: str = "documents") -> str:
    """CTEs up to ``juicio``: every document with its measures and verdict, EM unrolled step by step."""
    v = reglas.VENTANA
    votos = ", ".join(f"CASE WHEN {mala} THEN -1 WHEN {buena} THEN 1 ELSE 0 END AS v_{r}"
                      for r, (mala, buena) in reglas.REGLAS.items())
    nombres = ", ".join(f"v_{r}" for r in reglas.REGLAS)
    suma = "ln(p / (1 - p)) + " + " + ".join(
        f"CASE v_{r} WHEN 1 THEN ln(b_{r} / (1 - m_{r})) WHEN -1 THEN ln((1 - b_{r}) / m_{r}) ELSE 0 END"
        for r in reglas.REGLAS)
    q = f"1 / (1 + exp(-({suma})))"
    pasos = ["e0 AS (SELECT " + ", ".join(f"{x}::DOUBLE AS {k}" for k, x in reglas.inicial().items()) + ")"]
    c, b0, m0 = reglas.PREVIA, reglas.INICIO["buena"], reglas.INICIO["mala"]
    for k in range(reglas.VUELTAS):
        nuevos = [f"(coalesce(sum(q * n), 0) + {c * reglas.INICIO['p']}) / (coalesce(sum(n), 0) + {c}) AS p"]
        for r in reglas.REGLAS:
            nuevos += [
                f"(coalesce(sum(q * n) FILTER (v_{r} = 1), 0) + {c * b0}) / (coalesce(sum(q * n) FILTER (v_{r} <> 0), 0) + {c}) AS b_{r}",
                f"(coalesce(sum((1 - q) * n) FILTER (v_{r} = -1), 0) + {c * m0})"
                f" / (coalesce(sum((1 - q) * n) FILTER (v_{r} <> 0), 0) + {c}) AS m_{r}"]
        pasos.append(f"e{k + 1} AS MATERIALIZED (SELECT {', '.join(nuevos)} FROM (SELECT x.*, {q} AS q FROM patrones x, e{k}))")
    return f"""palabras AS (SELECT *, coalesce(text, '') AS t_, regexp_extract_all(coalesce(text, ''), '{NO_BLANCO}') AS w_,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{NO_BLANCO}')) AS l_ FROM {docs}),
ventanas AS (SELECT *, list_transform(range(1, len(w_) - {v - 2}), lambda i: array_to_string(w_[i : i + {v - 1}], ' ')) AS h_
    FROM palabras),
medidas AS (SELECT *, len(w_)::BIGINT AS n_words, len(array_to_string(w_, ''))::BIGINT AS word_chars,
    len(t_) - len(translate(t_, '#*$%&|<>', '')) AS n_symbols, len(t_) - len(translate(t_, '!', '')) AS n_exclama, len(t_) - len(replace(t_, '|', '')) AS n_barras,
    len(regexp_replace(t_, '[\\p{{L}}\\p{{N}}\\x20\\x09-\\x0D]+', '', 'g')) AS n_otros,
    len(regexp_replace(t_, '[^\\p{{Lu}}]+', '', 'g')) AS n_mayus, len(l_) AS n_lineas,
    len(l_) - len(list_distinct(l_)) AS n_dup_lines FROM ventanas),
dobles AS (SELECT k_, count(DISTINCT q) AS n_dobles FROM (
    SELECT k_, unnest(range(i, i + {v})) AS q FROM (
        SELECT k_, i, count(*) OVER (PARTITION BY k_, h) AS n FROM (
            SELECT doc_id AS k_, unnest(h_) AS h, unnest(range(len(h_))) AS i FROM ventanas)) WHERE n > 1) GROUP BY k_),
todas AS (SELECT m.*, coalesce(n_dobles, 0) AS n_repeat_words FROM medidas m LEFT JOIN dobles ON k_ = doc_id),
votos AS MATERIALIZED (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, {votos} FROM todas),
patrones AS MATERIALIZED (SELECT {nombres}, count(*) AS n FROM votos GROUP BY ALL),
{', '.join(pasos)},
juicio AS (SELECT x.*, NOT base_failed AND {q} >= 0.5 AS kept FROM votos x, e{reglas.VUELTAS})"""


def _chat() -> str:
    abre, cierra = len(chat.ABRE), len(chat.CIERRA)
    return rf"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations UNION ALL
    SELECT -1, k, CASE k WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok' FROM range(2) u(k))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
    coalesce(sum(len(t)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (r = 'assistant'), '')) AS loss_sha256,
    sum({abre + cierra + 1} + len(r) + 2 * (len(r) - len(replace(replace(r, '%', ''), chr(10), '')))
        + len(regexp_extract_all(r, '<\\*\|')) + len(t) + len(regexp_extract_all(t, '<\\*\|')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id"""


def _mejores() -> str:
    """All queries against all rows."""
    return """WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
               vec_id, score FROM s) WHERE rank <= 10"""


def _periodos() -> str:
    """Places whose word returns so many words later, as islands of neighbours for each distance."""
    return rf"""WITH RECURSIVE bits AS (SELECT i, 0 AS k, i::BIGINT AS v FROM range(256) u(i) UNION ALL
    SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
tabla AS (SELECT i, v FROM bits WHERE k = 8),
resto AS (SELECT doc_id, doc_id::VARCHAR AS t, 1 AS k, 4294967295::BIGINT AS v FROM documents UNION ALL
    SELECT doc_id, t, k + 1, xor(r.v >> 8, x.v) FROM resto r JOIN tabla x ON x.i = xor(r.v & 255, ascii(t[k])) WHERE k <= len(t)),
h AS (SELECT doc_id, xor(v, 4294967295) AS h FROM resto WHERE k = len(t) + 1),
d AS (SELECT doc_id, h, h // 10 AS g, regexp_extract_all(coalesce(text, ''), '{NO_BLANCO}') AS w FROM documents JOIN h USING (doc_id)),
l AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN g % len(w) END AS a FROM d),
t AS (SELECT doc_id, n, i, CASE WHEN i < coalesce(a, n) THEN w[i + 1]
             ELSE w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END AS palabra FROM l, unnest(range(n)) u(i)),
par AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.palabra = y.palabra
        AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
isla AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS largo FROM (
          SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS b FROM par) GROUP BY doc_id, q, b),
run AS (SELECT doc_id, s, largo, min(q) AS q FROM isla WHERE largo >= greatest(6, 4 * q) GROUP BY ALL),
fuera AS (SELECT DISTINCT doc_id, i FROM run, unnest(range(s + q, s + largo)) u(i)),
quedan AS (SELECT doc_id, string_agg(palabra, ' ' ORDER BY i) AS c FROM t ANTI JOIN fuera USING (doc_id, i) GROUP BY doc_id),
todas AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || largo || ',' || q || chr(10), '' ORDER BY s, q) AS c
          FROM run GROUP BY doc_id),
una AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY largo / q DESC, s, q) = 1)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, s::BIGINT AS start, largo::BIGINT AS length, q::BIGINT AS period,
    (1000 * largo // q)::BIGINT AS exponent_milli, sha256(coalesce(todas.c, '')) AS runs_sha256,
    sha256(coalesce(quedan.c, '')) AS collapsed_sha256
FROM d LEFT JOIN todas USING (doc_id) LEFT JOIN una USING (doc_id) LEFT JOIN quedan USING (doc_id)"""


def oraculo() -> dict[str, str]:
    return {
        "op1_descontaminacion": contaminacion(),
        "op2_licencias": _licencias(),
        "op6_reglas": f"""WITH {calidad()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM juicio""",
        "op9_chat": _chat(),
        "op11_mejores": _mejores(),
        "op12_periodos": _periodos(),
    }
