"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

DataFrame functions only.  The votes of a text are a pattern of ``len(REGLAS)`` values out of three, so the
corpus reduces to at most ``3 ** len(REGLAS)`` counted patterns and each EM step is one small aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from comanda.plans.durable import Corte

#: name: (votes bad if, votes good if); it abstains where neither holds.  Columns are those of ``medidas``.
REGLAS = {
    "simbolos": ("10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    "mezcla": ("10 * n_otros > 3 * word_chars", "10 * n_otros <= word_chars"),
    "columnas": ("10 * n_barras > n_words", "50 * n_barras <= n_words"),
    "gritos": ("5 * n_exclama > n_words", "25 * n_exclama <= n_words"),
    "mayusculas": ("10 * n_mayus > 4 * word_chars", "10 * n_mayus <= 2 * word_chars"),
    "largo_palabra": ("word_chars < 2 * n_words OR word_chars > 15 * n_words",
                      "2 * word_chars >= 5 * n_words AND word_chars <= 10 * n_words"),
    "lineas": ("10 * n_dup_lines > 3 * n_lineas", "n_dup_lines = 0"),
    "repeticion": ("10 * n_repeat_words > 3 * n_words", "n_repeat_words = 0"),
}
VUELTAS = 12
#: Starting point and strength (in votes) of the prior on accuracies.  A bad text breaks few rules, a good one
#: hardly any: that is what tells the two classes apart before the first step.
INICIO = {"p": 0.9, "buena": 0.98, "mala": 0.3}
PREVIA = 20.0

# the window length and the base thresholds are part of the operator's definition
VENTANA = 8


def _ventanas() -> str:
    """Hash of each window of eight words: of words, then of pairs, fours and eights of neighbours.

    An array of one and its element bind a name: each step is computed once, not once an element."""
    nivel = "transform(w, x -> xxhash64(x))"
    for paso in (1, 2, 4):
        nivel = f"transform(array({nivel}), a -> transform(a, (x, i) -> xxhash64(x, get(a, i + {paso}))))[0]"
    return f"IF(size(w) < {VENTANA}, CAST(array() AS ARRAY<BIGINT>), slice({nivel}, 1, size(w) - {VENTANA - 1}))"


def _repetidas() -> str:
    """Words inside a window of eight that stands twice or more, from window hashes and their places."""
    return f"""CASE WHEN size(h) = size(array_distinct(h)) THEN 0L ELSE
        transform(array(array_sort(transform(h, (x, i) -> struct(x, i)))), s ->
          transform(array(array_sort(transform(filter(sequence(0, size(s) - 1),
              k -> s[k].x <=> get(s, k - 1).x OR s[k].x <=> get(s, k + 1).x), k -> s[k].i))), p ->
            aggregate(sequence(0, size(p) - 1), 0L, (a, k) ->
              a + least({VENTANA}, coalesce(get(p, k + 1) - p[k], {VENTANA}))))[0])[0] END"""


def medidas(docs: DataFrame, texto: str = "text", conservar: list[str] | None = None) -> DataFrame:
    """``fila`` (the columns ``conservar``, all by default) and the measures of each text.

    Null text is empty and has no words.  Everything is computed inside the row, so a text of any length or
    a group of copies costs its own size only; the sort that finds repeated windows runs only where one is.
    """
    c = docs.columns if conservar is None else conservar
    t = F.coalesce(docs[f"`{texto}`"], F.lit(""))
    sin = lambda patron: F.length(F.regexp_replace("t", patron, "")).cast("bigint")
    veces = lambda x: (F.length("t") - F.length(F.replace("t", F.lit(x), F.lit("")))).cast("bigint")
    base = docs.select(F.struct(*[docs[f"`{x}`"] for x in c]).alias("fila"), t.alias("t"))
    m = base.select(
        "fila", F.expr(r"regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+', 0)").alias("w"),
        F.expr(r"filter(split(t, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')").alias("lineas"),
        sin(r"[\x20\x09-\x0D]+").alias("word_chars"), sin(r"[^#*$%&|<>]+").alias("n_symbols"),
        veces("!").alias("n_exclama"), veces("|").alias("n_barras"),
        # characters in words that are neither letters nor digits, and capital letters
        sin(r"[\p{L}\p{N}\x20\x09-\x0D]+").alias("n_otros"), sin(r"[^\p{Lu}]+").alias("n_mayus"))
    m = m.select(
        "fila", "word_chars", "n_symbols", "n_exclama", "n_barras", "n_otros", "n_mayus",
        F.size("w").cast("bigint").alias("n_words"), F.size("lineas").cast("bigint").alias("n_lineas"),
        (F.size("lineas") - F.size(F.array_distinct("lineas"))).cast("bigint").alias("n_dup_lines"),
        F.expr(_ventanas()).alias("h"))
    m = m.withColumn("n_repeat_words", F.expr(_repetidas())).drop("h")
    return m.withColumn("base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words"))


def _votos() -> list[Column]:
    return [F.expr(f"CASE WHEN {mala} THEN -1 WHEN {buena} THEN 1 ELSE 0 END").alias(f"v_{r}")
            for r, (mala, buena) in REGLAS.items()]


def _posterior(p: dict[str, float]) -> Column:
    """Probability of a good text given its votes; abstentions say nothing."""
    c = F.log(F.lit(p["p"] / (1 - p["p"])))
    for r in REGLAS:
        b, m = p[f"b_{r}"], p[f"m_{r}"]
        c = c + F.when(F.col(f"v_{r}") == 1, F.log(F.lit(b / (1 - m)))).when(
            F.col(f"v_{r}") == -1, F.log(F.lit((1 - b) / m))).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-c))


def inicial() -> dict[str, float]:
    return {"p": INICIO["p"]} | {f"b_{r}": INICIO["buena"] for r in REGLAS} | {f"m_{r}": INICIO["mala"] for r in REGLAS}


def estimar(patrones: DataFrame, vueltas: int = VUELTAS) -> dict[str, float]:
    """Share of good texts and, of each rule, how often it is right on good (``b_``) and bad (``m_``) texts.

    ``patrones`` has a column per rule and ``n``.  Two numbers a rule, since a rule that is nearly always
    right when it says bad may say little when it says good.  ``PREVIA`` votes at the starting value keep an
    accuracy defined when a rule never votes; over an empty table the starting values stay.
    """
    p = inicial()
    q = F.col("q") * F.col("n")
    resto = (1 - F.col("q")) * F.col("n")
    for _ in range(vueltas):
        sumas = [F.sum("n").cast("double").alias("n"), F.sum(q).alias("p")]
        for r in REGLAS:
            v = F.col(f"v_{r}")
            sumas += [F.sum(F.when(v == 1, q).otherwise(0.0)).alias(f"b_{r}"),
                      F.sum(F.when(v != 0, q).otherwise(0.0)).alias(f"nb_{r}"),
                      F.sum(F.when(v == -1, resto).otherwise(0.0)).alias(f"m_{r}"),
                      F.sum(F.when(v != 0, resto).otherwise(0.0)).alias(f"nm_{r}")]
        s: Row = patrones.withColumn("q", _posterior(p)).agg(*sumas).first()
        if not s["n"]:
            break
        nuevo = {"p": (s["p"] + PREVIA * INICIO["p"]) / (s["n"] + PREVIA)}
        for r in REGLAS:
            nuevo[f"b_{r}"] = (s[f"b_{r}"] + PREVIA * INICIO["buena"]) / (s[f"nb_{r}"] + PREVIA)
            nuevo[f"m_{r}"] = (s[f"m_{r}"] + PREVIA * INICIO["mala"]) / (s[f"nm_{r}"] + PREVIA)
        p = nuevo
    return p


def evaluar(docs: DataFrame, texto: str = "text", conservar: list[str] | None = None) -> DataFrame:
    """``medidas`` with ``probabilidad`` and ``kept``: false if a base rule fails, else probability of 0.5 or more.

    The measures are written once to the shared folder: the estimate and the verdict both read them there.
    """
    corte = Corte(docs.sparkSession, "calidad")
    m, _ = corte.guardar(medidas(docs, texto, conservar).select("*", *_votos()))
    votos = [f"v_{r}" for r in REGLAS]
    patrones, _ = corte.guardar(m.groupBy(*votos).agg(F.count("*").alias("n")))
    q = _posterior(estimar(patrones))
    return m.withColumn("probabilidad", q).withColumn("kept", ~F.col("base_failed") & (F.col("probabilidad") >= 0.5))


def buenos(docs: DataFrame, texto: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are kept."""
    return evaluar(docs, texto).filter("kept").select("fila.*")
