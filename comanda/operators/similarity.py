"""Jaccard similarity of entities that share items (users by products, products by orders).

An exact set-similarity join.  All sets are sorted by one order of the items, rarest first, and every item knows its
place in its set.  Two sets of n and m items that reach a threshold t share at least a = t (n + m) / (1 + t) items, hence
at least l of them among the first n - a + l of one and m - a + l of the other, for every l up to a (the prefix filter
of Bayardo et al., WWW 2007, extended as in AdaptJoin, Wang et al., SIGMOD 2012).  Sizes and places bound what a pair can
still share: when a shared item pairs two sets, and again when a pair's shared items are counted.  Entities with
identical sets are one profile with a member count, so a large group of copies is one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.functions.expr import cociente
from comanda.plans.durable import Corte
from comanda.plans.pares import FILAS_POR_TAREA, listas_en_grupo


@dataclass
class Similitud:
    """``miembros(entidad, perfil)``, ``perfiles(perfil, n, entidades)`` and
    ``aristas(a, b, comunes, score)`` between different profiles, a < b."""

    miembros: DataFrame
    perfiles: DataFrame
    aristas: DataFrame


def similitud(conjuntos: DataFrame, umbral: float) -> Similitud:
    """``conjuntos(entidad, item)`` without repeated rows; pairs with score >= ``umbral`` > 0.

    Each table that several later steps read is written once."""
    corte = Corte(conjuntos.sparkSession, "similitud")
    conjuntos, _ = corte.guardar(conjuntos)
    huella = conjuntos.groupBy("entidad").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("item")).alias("h1"),
        F.sum(F.xxhash64("item", F.lit(1)).cast("decimal(20,0)")).alias("h2"))
    marca = ["n", "h1", "h2"]
    con_marca = huella.groupBy(*marca).agg(F.min("entidad").alias("perfil"), F.count("*").alias("entidades"))
    miembros = huella.join(con_marca.select(*marca, "perfil"), marca).select("entidad", "perfil")
    perfiles = con_marca.select("perfil", "n", "entidades")
    perfiles, _ = corte.guardar(perfiles)
    aristas, _ = corte.guardar(_pares(conjuntos.withColumnRenamed("entidad", "perfil")
                                      .join(perfiles.select("perfil", "n"), "perfil"), umbral, corte))
    return Similitud(miembros, perfiles, aristas)


#: Extensions of the prefix that are weighed, and by how much the longest one taken may add to the rows paired.
EXTENSIONES = (1, 2, 4, 8)
HOLGURA = 1.25


def _con_lugar(s: DataFrame, corte: Corte) -> DataFrame:
    """Adds ``lugar``, the place of each item in its set, from 0, rarest first, to ``s(perfil, item, n, f)``.

    Rows are dealt out by ranges of set, frequency and item, so that a set with very many items is many ranges; its
    places go on from one range to the next by counts of one row per set and range.
    """
    orden = ["perfil", "f", "item"]
    t, _ = corte.guardar(s.repartitionByRange(*orden).sortWithinPartitions(*orden)
                         .withColumn("_m", F.monotonically_increasing_id()))
    rango = F.shiftright("_m", 33)
    cuentas = t.groupBy("perfil", rango.alias("_r")).agg(F.min("_m").alias("_desde"), F.count("*").alias("_c"))
    antes = W.partitionBy("perfil").orderBy("_r").rowsBetween(W.unboundedPreceding, -1)
    inicios = cuentas.withColumn("_a", F.coalesce(F.sum("_c").over(antes), F.lit(0))).drop("_c")
    # items that nobody shares are rarest of all: they come first and are already gone from s
    vistos = cuentas.groupBy("perfil").agg(F.sum("_c").alias("_v"))
    inicios = inicios.join(vistos, "perfil")
    return (t.withColumn("_r", rango).join(inicios, ["perfil", "_r"])
            .select("perfil", "item", "n", "f", (F.col("_m") - F.col("_desde") + F.col("_a") + F.col("n") - F.col("_v"))
                    .alias("lugar")))


def _prefijo(t: float, l: int, n: str = "n") -> Column:
    return F.least(F.col(n), F.col(n) - F.ceil(F.lit(t) * F.col(n) - F.lit(1e-9)) + l)


def _extension(s: DataFrame, t: float) -> tuple[int, int]:
    """The longest extension whose pairings are at most ``HOLGURA`` times those of the shortest prefix, and their number:
    where nearly the whole set is prefix anyway, a longer one costs little and leaves nothing to verify."""
    en = s.groupBy("item").agg(*[F.count(F.when(F.col("lugar") < _prefijo(t, l), 1)).alias(f"l{l}") for l in EXTENSIONES])
    filas = en.agg(*[F.sum(F.col(f"l{l}").cast("double") * (F.col(f"l{l}") - 1)).alias(f"l{l}") for l in EXTENSIONES]).first()
    corto = filas[f"l{EXTENSIONES[0]}"] or 0
    l = max(l for l in EXTENSIONES if (filas[f"l{l}"] or 0) <= HOLGURA * corto)
    return l, int((filas[f"l{l}"] or 0) / 2)


def _minimo(t: float, na: Column, nb: Column) -> Column:
    """Least number of shared items with which sets of these sizes can reach t, to rounding."""
    return F.ceil(F.lit(t / (1 + t)) * (na + nb) - F.lit(1e-9))


#: Pairings of one task when a pair's shared items are counted.
PAREJAS_POR_TAREA = 2 * FILAS_POR_TAREA


def candidatos(sets: DataFrame, t: float, corte: Corte) -> tuple[DataFrame, DataFrame]:
    """Pairs of ``sets(perfil, item, n)`` that may reach t: (a, b, na, nb, pp, la, quedan), where ``a`` is the smaller set,
    ``pp`` items are shared within both prefixes, the last one at ``la`` of a, and at most ``quedan`` more behind them; and
    the sets' items with their places.

    Of two sets that share an item the smaller one gets the other's name, in one list an item; the lists of a set come
    together, so its pairs are counted where they are read and no pair is shuffled as a row.
    """
    frecuencia = sets.groupBy("item").agg(F.count("*").alias("f"))
    s, filas = corte.guardar(_con_lugar(sets.join(frecuencia.filter("f > 1"), "item"), corte))
    l, parejas = _extension(s, t)
    prefijos = s.filter(F.col("lugar") < _prefijo(t, l))

    def va(p: Column, q: Column) -> Column:
        na, nb, i, j = p["n"], q["n"], p["lugar"], q["lugar"]
        menor = (na < nb) | ((na == nb) & (p["perfil"] < q["perfil"]))
        # before this item at most as many are shared as stand before it, behind it as many as are left
        return (menor & (na >= F.lit(t) * nb - F.lit(1e-9))
                & (F.least(i, j) + F.least(na - i, nb - j) >= _minimo(t, na, nb)))

    listas = listas_en_grupo(prefijos, ["item"], ["perfil", "n", "lugar"], "perfil", va, "f", filas)
    partes = [-(-parejas // PAREJAS_POR_TAREA)] if parejas > PAREJAS_POR_TAREA else []
    c = (listas.select(F.col("perfil").alias("a"), F.col("n").alias("na"), F.col("lugar").alias("la"), "perfils")
         .repartition(*partes, "a").select("a", "na", "la", F.explode("perfils").alias("b"))
         .groupBy("a", "na", "b").agg(F.count("*").alias("pp"), F.max("la").alias("la"))
         # the other set is not smaller
         .filter(F.col("pp") >= F.least(F.lit(l), _minimo(t, F.col("na"), F.col("na")))))
    # the last place of a set that shares anything is in s
    c = c.join(s.filter("lugar = n - 1").select(F.col("perfil").alias("b"), F.col("n").alias("nb")), "b")
    na, nb = F.col("na"), F.col("nb")
    fuera = lambda n: F.col(n) - _prefijo(t, l, n)
    minimo = _minimo(t, na, nb)
    return (c.withColumn("quedan", F.least(na - 1 - F.col("la"), fuera("na") + fuera("nb")))
            .filter(F.col("pp") >= F.least(F.lit(l), minimo)).filter(F.col("pp") + F.col("quedan") >= minimo), s)


def _pares(sets: DataFrame, t: float, corte: Corte) -> DataFrame:
    """Pairs of ``sets(perfil, item, n)`` with Jaccard >= t and their shared item count."""
    c, s = candidatos(sets, t, corte)
    c, _ = corte.guardar(c)
    # what a pair shares behind its last shared prefix item, looked up from the smaller set
    faltan = c.filter("quedan > 0").select("a", "b", F.col("a").alias("perfil"), "la")
    extra = (faltan.join(s.select("perfil", "item", "lugar"), "perfil").filter(F.col("lugar") > F.col("la"))
             .join(s.select(F.col("perfil").alias("b"), "item"), ["b", "item"])
             .groupBy("a", "b").agg(F.count("*").alias("extra")))
    comunes = F.col("pp") + F.coalesce("extra", F.lit(0))
    return (c.join(extra, ["a", "b"], "left").withColumn("comunes", comunes)
            .withColumn("score", _score(F.col("comunes"))).filter(F.col("score") >= t)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "comunes", "score"))


def _score(comunes):
    return cociente(comunes, F.col("na") + F.col("nb") - comunes)


def resumen_por_entidad(s: Similitud) -> DataFrame:
    """Per entity: number of similar entities, summed score, summed shared items and the score
    range, counting every entity behind a profile (members of the own profile have score 1)."""
    e = s.aristas
    ambos = e.selectExpr("a AS perfil", "b AS otro", "comunes", "score").unionByName(
        e.selectExpr("b AS perfil", "a AS otro", "comunes", "score"))
    puntos = F.col("score").cast("decimal(20,12)")
    peso = F.col("entidades")
    fuera = (ambos.join(s.perfiles.selectExpr("perfil AS otro", "entidades"), "otro")
             .groupBy("perfil").agg(F.sum(peso).alias("total"), F.sum(puntos * peso).alias("suma"),
                                    F.sum(F.col("comunes") * peso).alias("comunes"),
                                    F.min("score").alias("minimo"), F.max("score").alias("maximo")))
    copias = F.col("entidades") - 1
    hay = copias > 0
    cero = F.lit(0)
    por_perfil = s.perfiles.join(fuera, "perfil", "left").select(
        "perfil", (F.coalesce("total", cero) + copias).alias("total"),
        (F.coalesce("suma", cero) + copias).cast("decimal(38,12)").alias("suma_score"),
        (F.coalesce("comunes", cero) + copias * F.col("n")).alias("productos_comunes"),
        F.least("minimo", F.when(hay, F.lit(1.0))).alias("score_min"),
        F.greatest("maximo", F.when(hay, F.lit(1.0))).alias("score_max"))
    return s.miembros.join(por_perfil.filter("total > 0"), "perfil").drop("perfil")


def resumen_de_aristas(aristas: DataFrame, lado: str = "src") -> DataFrame:
    """The same summary from a plain edge table (src, dst, score, productos_comunes)."""
    return aristas.groupBy(F.col(lado).alias("entidad")).agg(
        F.count("*").alias("total"), F.sum(F.col("score").cast("decimal(20,12)")).alias("suma_score"),
        F.sum("productos_comunes").alias("productos_comunes"), F.min("score").alias("score_min"),
        F.max("score").alias("score_max"))
