"""Products bought together.

Baskets are reduced to one row per order and product before they are paired, and pair
statistics are rebuilt from per-product counts and sums.  A ranking of k pairs first drops
the products that cannot be in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.functions.expr import cociente
from comanda.plans.durable import Corte
from comanda.plans.pares import FILAS_POR_TAREA, pares_en_grupo

SEMILLAS = 256


def cestas(detalle: DataFrame) -> DataFrame:
    """(src, dst) with line count, units and amount, from detail edges order -> product."""
    return detalle.groupBy("src", "dst").agg(
        F.count("*").alias("n"), F.sum("cantidad").cast("bigint").alias("u"),
        F.sum(F.col("subtotal").cast("decimal(18,2)")).alias("s"))


def pares_de_productos(cesta: DataFrame, grupo: list[str] | None = None, bloque: int | None = 512,
                       filas: int | None = None) -> DataFrame:
    """One row per product pair: times together and the summed units and amount of both lines.  With ``filas``, the rows of
    ``cesta``, they are paired in tasks of a known number of them."""
    p = pares_en_grupo(cesta, grupo or ["src"], "dst", ["n", "u", "s"], bloque, filas)
    n1, n2 = F.col("n_menor"), F.col("n_mayor")
    return p.groupBy(F.col("menor").alias("prod1"), F.col("mayor").alias("prod2")).agg(
        F.sum(n1 * n2).alias("veces"),
        F.sum(F.col("u_menor") * n2 + F.col("u_mayor") * n1).alias("unidades"),
        F.sum(F.col("s_menor") * n2 + F.col("s_mayor") * n1).alias("importe"))


def _solo_posibles(cesta: DataFrame, k: int, grupo: list[str]) -> DataFrame:
    """Drops products that cannot be in the k best pairs.

    A pair is counted at most (lines of one product) x (most lines of any product in one
    basket) times.  The pairs among the ``SEMILLAS`` most frequent products give a count that
    k pairs reach; products whose bound is below it are out.  Ties with that count stay in.
    """
    cota = (cesta.groupBy("dst").agg(F.sum("n").alias("lineas"))
            .withColumn("cota", F.col("lineas") * cesta.agg(F.max("n")).scalar()))
    semillas = cota.orderBy(F.desc("cota"), "dst").limit(SEMILLAS).select("dst")
    # at most SEMILLAS products per basket are left, no basket needs to be cut into blocks
    entre = pares_de_productos(cesta.join(F.broadcast(semillas), "dst", "left_semi"), grupo, bloque=None)
    corte = entre.orderBy(F.desc("veces")).limit(k).agg(
        F.when(F.count("*") == k, F.min("veces")).otherwise(F.lit(0)).alias("c"))
    vivos = cota.filter(F.col("cota") >= corte.scalar()).select("dst")
    return cesta.join(vivos, "dst", "left_semi")


def _mejores(cesta: DataFrame, k: int, grupo: list[str], orden: list) -> DataFrame:
    cesta, _ = Corte(cesta.sparkSession, "cestas").guardar(cesta)  # read three times below
    pares = pares_de_productos(_solo_posibles(cesta, k, grupo), grupo)
    return pares.withColumn("valor_promedio", cociente(F.col("importe"), F.col("veces"))).orderBy(*orden).limit(k)


def _con_titulos(pares: DataFrame, productos: DataFrame, orden: list) -> DataFrame:
    for lado in ("prod1", "prod2"):
        t = productos.select(F.col("id").alias(lado), F.col("titulo").alias(f"titulo_{lado}"))
        pares = pares.join(t, lado)
    return pares.orderBy(*orden)


def _por_veces() -> list:
    return [F.desc("veces"), "prod1", "prod2"]


def co_compras(detalle: DataFrame, productos: DataFrame, k: int = 5) -> DataFrame:
    """Best k pairs with the mean units of both lines together."""
    m = _con_titulos(_mejores(cestas(detalle), k, ["src"], _por_veces()), productos, _por_veces())
    return m.select(F.col("prod1").alias("id1"), F.col("prod2").alias("id2"), F.col("titulo_prod1").alias("prod1"),
                    F.col("titulo_prod2").alias("prod2"), "veces",
                    cociente(F.col("unidades"), F.col("veces")).alias("cantidad_promedio"))


def co_compras_valor(detalle: DataFrame, productos: DataFrame, k: int = 10) -> DataFrame:
    """Best k pairs by frequency and then by mean amount of both lines together."""
    orden = [F.desc("veces"), F.desc("valor_promedio"), "prod1", "prod2"]
    m = _con_titulos(_mejores(cestas(detalle), k, ["src"], orden), productos, orden)
    return m.select(F.col("prod1").alias("id1"), F.col("prod2").alias("id2"), F.col("titulo_prod1").alias("titulo1"),
                    F.col("titulo_prod2").alias("titulo2"), F.col("veces").alias("frecuencia"), "valor_promedio")


def co_compras_mismo_restaurante(detalle: DataFrame, productos: DataFrame, k: int = 5) -> DataFrame:
    """Best k pairs of products of the same restaurant."""
    r = productos.select(F.col("id").alias("dst"), F.col("restaurante_id").alias("rest"))
    cesta = cestas(detalle).join(r, "dst").filter("rest IS NOT NULL")
    m = _con_titulos(_mejores(cesta, k, ["src", "rest"], _por_veces()), productos, _por_veces())
    return m.select(F.col("prod1").alias("id1"), F.col("prod2").alias("id2"), F.col("titulo_prod1").alias("titulo1"),
                    F.col("titulo_prod2").alias("titulo2"), F.col("veces").alias("co_compras"))


def co_compras_categoria(detalle: DataFrame, productos: DataFrame, k: int = 5, minimo: int = 5) -> DataFrame:
    """Category combinations within an order, both orders of each pair.  Lines are counted per
    order and category first, so an order contributes at most one row per category."""
    cat = productos.select(F.col("id").alias("dst"), "categoria").filter("categoria IS NOT NULL")
    corte = Corte(detalle.sparkSession, "categorias")
    lineas, n = corte.guardar(detalle.select("src", "dst").join(cat, "dst").select("src", "categoria"))
    if n > FILAS_POR_TAREA:
        lineas = lineas.repartition(-(-n // FILAS_POR_TAREA), "src", "categoria")
    # read three times below
    por_cat, filas = corte.guardar(lineas.groupBy("src", "categoria").agg(F.count("*").alias("n")))
    pares = pares_en_grupo(por_cat, ["src"], "categoria", ["n"], filas=filas)
    n = pares.groupBy("menor", "mayor").agg(F.sum(F.col("n_menor") * F.col("n_mayor")).alias("combinaciones"))
    ambos = n.select(F.inline(F.array(
        F.struct(F.col("menor").alias("cat1"), F.col("mayor").alias("cat2")),
        F.struct(F.col("mayor").alias("cat1"), F.col("menor").alias("cat2")))), "combinaciones")
    return (ambos.filter(F.col("combinaciones") >= minimo)
            .orderBy(F.desc("combinaciones"), "cat1", "cat2").limit(k))
