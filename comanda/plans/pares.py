"""Pairs of members that share a group, and joins by key, without one task ever holding a large group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: A key with more than this part of a join's rows is full.
PARTE_LLENA = 1000
#: Rows of one task of a join whose size is known.
FILAS_POR_TAREA = 1_000_000
#: Members of one task that makes lists of others for each of them.
MIEMBROS_POR_TAREA = 250_000


def repartida(df: DataFrame) -> DataFrame:
    """``df`` for a join that deals both sides out by key.  Spark chooses a broadcast by the size of the files, which is a
    fraction of that of the rows: a table that grows with the input would go whole through the driver's memory."""
    return df.hint("merge")


def unir_por_clave(filas: DataFrame, tabla: DataFrame, clave: str, total: int) -> DataFrame:
    """Joins rows with one row per key, which counts in ``n`` the rows of that key (``total`` in all).  Keys with more
    than a thousandth of them, of which there are fewer than a thousand, go by broadcast and never meet in one task."""
    umbral = total / PARTE_LLENA
    valores = [c for c in tabla.columns if c not in (clave, "n")]
    llenas = tabla.filter(F.col("n") > umbral).drop("n").withColumn("_llena", F.lit(True))
    con = filas.join(F.broadcast(llenas), clave, "left")
    resto = con.filter("_llena IS NULL").drop("_llena", *valores)
    return (con.filter("_llena").drop("_llena")
            .unionByName(resto.join(tabla.filter(F.col("n") <= umbral).drop("n"), clave)))


def pares_en_grupo(df: DataFrame, grupo: list[str], miembro: str, valores: list[str],
                   bloque: int | None = 512, filas: int | None = None) -> DataFrame:
    """Unordered member pairs (``menor`` < ``mayor``) per group, with both sides' values as
    ``x_menor`` and ``x_mayor``.  ``df`` has one row per group and member.

    A group of more than ``bloque`` members is cut into blocks by member hash; a pair of
    blocks is one join key, so no key has more than about ``bloque`` rows on a side.  ``None``
    is for groups known to be small.  With ``filas``, the rows of ``df``, the join has a task for every
    ``FILAS_POR_TAREA`` of them: Spark sizes tasks by shuffled bytes, and small numbers shrink to a fraction there.
    """
    if bloque is None:
        a = df.select(*grupo, F.col(miembro).alias("menor"), *[F.col(v).alias(f"{v}_menor") for v in valores])
        b = df.select(*grupo, F.col(miembro).alias("mayor"), *[F.col(v).alias(f"{v}_mayor") for v in valores])
        return a.join(b, grupo).filter("menor < mayor")
    grandes = (df.groupBy(*grupo).agg(F.count("*").alias("_n")).filter(F.col("_n") > bloque)
               .select(*grupo, F.ceil(F.col("_n") / bloque).cast("int").alias("_nb")))
    base = (df.select(*grupo, miembro, *valores).join(grandes, grupo, "left")
            .withColumn("_nb", F.coalesce("_nb", F.lit(1)))
            .withColumn("_b", F.pmod(F.xxhash64(miembro), F.col("_nb")).cast("int")))
    izq = base.select(*grupo, F.col("_b").alias("_x"), F.explode(F.sequence("_b", F.col("_nb") - 1)).alias("_y"),
                      F.struct(F.col(miembro).alias("_m"), *valores).alias("a"))
    der = base.select(*grupo, F.explode(F.sequence(F.lit(0), F.col("_b"))).alias("_x"), F.col("_b").alias("_y"),
                      F.struct(F.col(miembro).alias("_m"), *valores).alias("b"))
    if filas is not None and filas > FILAS_POR_TAREA:
        partes = -(-filas // FILAS_POR_TAREA)
        izq = izq.repartition(partes, *grupo, "_x", "_y")
        der = repartida(der.repartition(partes, *grupo, "_x", "_y"))
    en_orden = F.col("a._m") < F.col("b._m")
    pares = izq.join(der, [*grupo, "_x", "_y"]).filter((F.col("_x") < F.col("_y")) | en_orden)
    menor = F.when(en_orden, F.col("a")).otherwise(F.col("b"))
    mayor = F.when(en_orden, F.col("b")).otherwise(F.col("a"))
    return pares.select(
        *grupo, menor.getField("_m").alias("menor"), mayor.getField("_m").alias("mayor"),
        *[menor.getField(v).alias(f"{v}_menor") for v in valores],
        *[mayor.getField(v).alias(f"{v}_mayor") for v in valores])


def listas_en_grupo(df: DataFrame, grupo: list[str], datos: list[str], salida: str, va: Callable[[Column, Column], Column],
                    cuantos: str, filas: int, bloque: int = 512) -> DataFrame:
    """Per group and member (``datos``) the list ``salida`` + ``s`` of the members that ``va(member, other)`` accepts.

    A pair is one value of a list and not a row, so a shuffle of pairs moves a fraction of the bytes.  Column ``cuantos`` is
    the size of the member's group or more; a group of more than ``bloque`` members is cut into blocks, and a pair of
    blocks is a join key: no list is longer than about a block.  ``filas`` is the rows of ``df``, for tasks of
    ``MIEMBROS_POR_TAREA`` of them.
    """
    partes = [-(-filas // MIEMBROS_POR_TAREA)] if filas > MIEMBROS_POR_TAREA else []
    lista = F.collect_list(F.struct(*datos)).alias("l")
    juntos = (df.filter(F.col(cuantos) <= bloque).select(*grupo, *datos).repartition(*partes, *grupo).groupBy(*grupo)
              .agg(lista).select(F.col("l").alias("de"), F.col("l").alias("con")))
    nb = F.ceil(F.col(cuantos) / bloque).cast("int")
    bloques = (df.filter(F.col(cuantos) > bloque).select(*grupo, *datos, nb.alias("_nb"))
               .withColumn("_b", F.pmod(F.xxhash64(*datos), F.col("_nb")).cast("int"))
               .groupBy(*grupo, "_nb", "_b").agg(lista))
    cada = F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))
    de = bloques.select(*grupo, F.col("_b").alias("_x"), cada.alias("_y"), F.col("l").alias("de"))
    con = bloques.select(*grupo, cada.alias("_x"), F.col("_b").alias("_y"), F.col("l").alias("con"))
    todas = juntos.unionByName(de.join(repartida(con), [*grupo, "_x", "_y"]).select("de", "con"))
    return (todas.select(F.explode("de").alias("_p"), "con")
            .select("_p.*", F.transform(F.filter("con", lambda q: va(F.col("_p"), q)), lambda q: q[salida]).alias(f"{salida}s"))
            .filter(F.size(f"{salida}s") > 0))
