"""PageRank and connected components as iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.plans.durable import Corte

PASO_SAL = 100_000


def _paso(rango: str, amortiguacion: float) -> str:
    """One iteration over the ranks ``rango``: shares sent along the edges plus the fixed part."""
    return f"""SELECT id, max(grado) AS grado, max(sales) AS sales, sum(score) AS score FROM (
        SELECT e.dst AS id, CAST(NULL AS BIGINT) AS grado, CAST(NULL AS INT) AS sales, x.parte AS score
        FROM (SELECT id, score / grado * {amortiguacion}D AS parte, explode(sequence(0, sales - 1)) AS sal
              FROM ({rango}) WHERE grado > 0) x JOIN {{e}} e ON e.src = x.id AND e.sal = x.sal
        UNION ALL SELECT id, grado, sales, score FROM {{fijo}}) GROUP BY id"""


def pagerank(nodos: DataFrame, aristas: DataFrame, iteraciones: int = 20, amortiguacion: float = 0.85,
             pasos_por_corte: int = 5, paso_sal: int = PASO_SAL) -> DataFrame:
    """Unnormalised PageRank (id, score) of ``nodos(id)`` over directed ``aristas(src, dst)``.

    A source with more than ``paso_sal`` edges is split into as many salted keys as needed, so
    no join key carries more than that.  Sums into a target are combined before the shuffle.
    """
    spark = nodos.sparkSession
    corte = Corte(spark, "pagerank")
    base = 1.0 - amortiguacion
    grado = aristas.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("grado"))
    estado, _ = corte.guardar(
        nodos.select("id").join(grado, "id", "left")
        .select("id", F.coalesce("grado", F.lit(0).cast("bigint")).alias("grado"),
                F.ceil(F.greatest(F.coalesce("grado", F.lit(1).cast("bigint")), F.lit(1)) / paso_sal)
                .cast("int").alias("sales")))
    sales = estado.select(F.col("id").alias("src"), "sales")
    e = corte.guardar_por_clave(aristas.join(sales, "src").select(
        "src", "dst", F.pmod(F.xxhash64("dst"), F.col("sales")).cast("int").alias("sal")), ["src", "sal"])
    fijo = estado.select("id", "grado", "sales", F.lit(base).alias("score"))
    rango, hechas = fijo, 0
    while hechas < iteraciones:
        texto = "SELECT * FROM {rango}"
        for _ in range(min(pasos_por_corte, iteraciones - hechas)):
            texto = _paso(texto, amortiguacion)
            hechas += 1
        rango, _ = corte.avanzar(spark.sql(texto, rango=rango, e=e, fijo=fijo))
    corte.cerrar()
    return rango.select("id", "score")


def usuarios_influyentes(usuarios: DataFrame, realizo: DataFrame, k: int = 10) -> DataFrame:
    """Best k users by PageRank on the undirected user - order graph.  The id's parity tells
    users (even) from orders (odd)."""
    u, p = F.col("src") * 2, F.col("dst") * 2 + 1
    aristas = realizo.select(F.inline(F.array(F.struct(u.alias("src"), p.alias("dst")),
                                              F.struct(p.alias("src"), u.alias("dst")))))
    nodos = usuarios.select((F.col("id") * 2).alias("id")).unionByName(
        realizo.select((F.col("dst") * 2 + 1).alias("id")).distinct())
    r = (pagerank(nodos, aristas).filter("id % 2 = 0")
         .select((F.col("id") / 2).cast("bigint").alias("id"), F.round("score", 6).alias("score")))
    return (r.join(usuarios.select("id", "email", "rol"), "id").orderBy(F.desc("score"), "id").limit(k)
            .select("email", "rol", "score"))


def _unir_nodo(e: DataFrame, menor: DataFrame) -> DataFrame:
    """Joins edges with one row per node (u, m, n = its edges).  Nodes of more than ``PASO_SAL`` edges are at
    most one per so many edges, so their table is small and goes by broadcast; no other node fills a task."""
    grandes = F.broadcast(menor.filter(F.col("n") > PASO_SAL).drop("n"))
    resto = menor.filter(F.col("n") <= PASO_SAL).drop("n")
    return (e.join(resto, "u").unionByName(e.join(grandes, "u")))


def componentes(nodos: DataFrame, aristas: DataFrame) -> DataFrame:
    """Connected components (id, comunidad = smallest id), edges taken as undirected.

    Alternates large-star and small-star (Kiveris et al., SoCC 2014): edges are re-hung on the
    smallest known neighbour until every component is a star.  Rounds grow with the logarithm
    of the component size, and a node's many neighbours are never gathered in one place.
    """
    corte = Corte(nodos.sparkSession, "componentes")
    # one row per edge, larger end first
    e, n = corte.avanzar(aristas.filter("src <> dst").select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    firma = None
    while n:
        # large-star: every larger neighbour of u, and u, hang on the smallest of u's neighbourhood
        ambos = e.select(F.inline(F.array(F.struct(F.col("u"), F.col("v")),
                                          F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        menor = ambos.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
        grande = (_unir_nodo(ambos.filter("v > u"), menor).select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .filter("u <> v").distinct())
        # small-star: the smaller neighbours of u, and u, hang on the smallest of them
        menor2 = grande.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        chica = (_unir_nodo(grande, menor2)
                 .select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                          F.struct(F.col("u"), F.col("m").alias("v")))))
                 .filter("u <> v").distinct())
        e, n = corte.avanzar(chica)
        nueva = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                      F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
        if nueva == firma:
            break
        firma = nueva
    return (nodos.select("id").join(e.select(F.col("u").alias("id"), F.col("v").alias("m")), "id", "left")
            .select("id", F.coalesce("m", "id").alias("comunidad")))
