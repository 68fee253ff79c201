"""Nearest road node by grid cells, without comparing every point with every node.

Nodes are indexed by the occupied cells of a grid pyramid.  A point looks at the 5 x 5 cells
around it; of the occupied ones it keeps those that can hold the nearest node (the cell's
nearest edge is not farther than another cell's farthest corner) and descends to their
subcells.  An answer within two cell widths is final; other points retry one level coarser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.functions.geo import METROS_POR_GRADO, manhattan_grados, plana_grados, plana_m
from comanda.plans.durable import Corte
from comanda.plans.pares import repartida

RADIO_BUSQUEDA_M = 5000.0
CELDA = 0.002
FACTOR = 4
ANILLO = 2
#: Points of one cell that meet its nodes in one task; a cell with more is so many more join keys.
PUNTOS_POR_CELDA = 4096
#: A place with more than this part of all points is full.
PARTES = 1000
_METRICAS = {"plana": plana_grados, "manhattan": manhattan_grados}
_HOLGURA = 1e-9


def _celda(c: Column, lado: float) -> Column:
    return F.floor(c / lado)


def _padre(c: str) -> Column:
    return F.floor(F.col(c) / FACTOR)


def _cotas(metrica: str, lado: float) -> tuple[Column, Column]:
    """Smallest and largest distance in degrees from (plat, plon) to the cell (cx, cy)."""
    cerca, lejos = [], []
    for p, c in (("plat", "cx"), ("plon", "cy")):
        desde, hasta = F.col(c) * lado - F.col(p), (F.col(c) + 1) * lado - F.col(p)
        cerca.append(F.greatest(desde, -hasta, F.lit(0.0)))
        lejos.append(F.greatest(F.abs(desde), F.abs(hasta)))
    cero = F.lit(0.0)
    d = _METRICAS[metrica]
    return d(cerca[0], cerca[1], cero, cero), d(lejos[0], lejos[1], cero, cero)


def _podar(cand: DataFrame, metrica: str, lado: float) -> DataFrame:
    minimo, maximo = _cotas(metrica, lado)
    alcance = F.min(maximo).over(W.partitionBy("plat", "plon"))
    return (cand.withColumn("_min", minimo).withColumn("_tope", alcance)
            .filter(F.col("_min") <= F.col("_tope") + _HOLGURA).select("plat", "plon", "cx", "cy"))


def _por_celda(cand: DataFrame, nodos: DataFrame) -> DataFrame:
    """Candidates with the nodes of their cell, crowded cells cut by point."""
    celda = ["cx", "cy"]
    partes = F.ceil(F.count("*") / PUNTOS_POR_CELDA).alias("partes")
    pesadas = cand.groupBy(*celda).agg(partes).filter("partes > 1")
    n_partes = F.coalesce("partes", F.lit(1).cast("bigint"))
    izq = (cand.join(pesadas, celda, "left")
           .withColumn("parte", F.pmod(F.xxhash64("plat", "plon"), n_partes)).drop("partes"))
    der = (nodos.join(pesadas, celda, "left")
           .withColumn("parte", F.explode(F.sequence(F.lit(0).cast("bigint"), n_partes - 1))).drop("partes"))
    return izq.join(repartida(der), [*celda, "parte"])


def _volver(puntos: DataFrame, resueltos: DataFrame, lugares: DataFrame) -> DataFrame:
    """``puntos`` with the answer of their place, from ``lugares(plat, plon, n)`` with the number of points of each.

    A place with more than 1 / ``PARTES`` of all points is joined by broadcast: there are fewer than ``PARTES`` of them
    whatever the size, and its points stay where they are.  No other place can fill a task."""
    total = lugares.agg(F.sum("n")).first()[0] or 0
    lugar = ["plat", "plon"]
    llenos = F.broadcast(lugares.filter(F.col("n") * PARTES > total).select(*lugar)
                         .join(repartida(resueltos), lugar, "left"))
    con = puntos.withColumn("plat", F.col("lat")).withColumn("plon", F.col("lon"))
    otros = con.join(F.broadcast(lugares.filter(F.col("n") * PARTES > total).select(*lugar)), lugar, "left_anti")
    return con.join(llenos, lugar).unionByName(otros.join(repartida(resueltos), lugar, "left")).drop(*lugar)


def mas_cercano(puntos: DataFrame, nodos: DataFrame, metrica: str = "plana",
                radio_m: float | None = None, celda: float = CELDA) -> DataFrame:
    """``puntos`` with calle_id, calle_lat, calle_lon and ``grados`` of the nearest node, ties to
    the smallest id.  With ``radio_m``, NULL where no node is nearer than that many metres."""
    corte = Corte(puntos.sparkSession, "cercano")
    # points and nodes at one place are one row each, however many share it; points are counted
    lugares, n_pend = corte.guardar(puntos.groupBy(F.col("lat").alias("plat"), F.col("lon").alias("plon"))
                                    .agg(F.count("*").alias("n")).filter("plat IS NOT NULL AND plon IS NOT NULL"))
    p = lugares.select("plat", "plon")
    n, _ = corte.guardar(
        nodos.groupBy("lat", "lon").agg(F.min("id").alias("calle_id"))
        .select("calle_id", F.col("lat").alias("calle_lat"), F.col("lon").alias("calle_lon"),
                _celda(F.col("lat"), celda).alias("cx"), _celda(F.col("lon"), celda).alias("cy")))
    ocupadas = [n.select("cx", "cy").distinct()]
    distancia = _METRICAS[metrica](F.col("plat"), F.col("plon"), F.col("calle_lat"), F.col("calle_lon"))
    pendientes, resueltos, nivel = p, [], 0
    vecinos = F.sequence(F.lit(-ANILLO), F.lit(ANILLO))
    while n_pend:
        lado = celda * FACTOR ** nivel
        ultimo = ANILLO * lado >= (360.0 if radio_m is None else radio_m / METROS_POR_GRADO)
        if len(ocupadas) <= nivel:
            ocupadas.append(ocupadas[-1].select(_padre("cx").alias("cx"), _padre("cy").alias("cy")).distinct())
        cand = (pendientes.withColumn("dx", F.explode(vecinos)).withColumn("dy", F.explode(vecinos))
                .select("plat", "plon", (_celda(F.col("plat"), lado) + F.col("dx")).alias("cx"),
                        (_celda(F.col("plon"), lado) + F.col("dy")).alias("cy"))
                .join(repartida(ocupadas[nivel]), ["cx", "cy"]))
        cand = _podar(cand, metrica, lado)
        for m in range(nivel - 1, -1, -1):
            hijas = ocupadas[m].select(F.col("cx").alias("hx"), F.col("cy").alias("hy"),
                                       _padre("cx").alias("cx"), _padre("cy").alias("cy"))
            cand = cand.join(repartida(hijas), ["cx", "cy"]).select("plat", "plon", F.col("hx").alias("cx"),
                                                         F.col("hy").alias("cy"))
            cand = _podar(cand, metrica, celda * FACTOR ** m)
        cand, _ = corte.guardar(cand)
        mejor = (_por_celda(cand, n).groupBy("plat", "plon")
                 .agg(F.min(F.struct(distancia.alias("grados"), "calle_id", "calle_lat", "calle_lon")).alias("m"))
                 .select("plat", "plon", "m.*"))
        if not ultimo:
            mejor = mejor.filter(F.col("grados") <= ANILLO * lado * (1 - _HOLGURA))
        hallados, _ = corte.guardar(mejor)
        resueltos.append(hallados)
        if ultimo:
            break
        pendientes, n_pend = corte.guardar(pendientes.join(repartida(hallados), ["plat", "plon"], "left_anti"))
        nivel += 1
    if not resueltos:
        vacia = n.select(F.col("calle_lat").alias("plat"), F.col("calle_lon").alias("plon"), F.lit(0.0).alias("grados"),
                         "calle_id", "calle_lat", "calle_lon")
        resueltos = [vacia.limit(0)]
    todos = resueltos[0]
    for r in resueltos[1:]:
        todos = todos.unionByName(r)
    if radio_m is not None:
        metros = plana_m(F.col("plat"), F.col("plon"), F.col("calle_lat"), F.col("calle_lon"))
        todos = todos.filter(metros < radio_m)
    # points without coordinates have no node; left out of the join they do not meet on one key
    sin_lugar = F.col("lat").isNull() | F.col("lon").isNull()
    con = _volver(puntos.filter(~sin_lugar), todos, lugares)
    return con.unionByName(puntos.filter(sin_lugar), allowMissingColumns=True)


def anclar_restaurantes(restaurantes: DataFrame, nodos: DataFrame) -> DataFrame:
    """Edges restaurant -> nearest node by Manhattan degrees; the stored distance is 0."""
    return (mas_cercano(restaurantes.select("id", "lat", "lon"), nodos, "manhattan").filter("calle_id IS NOT NULL")
            .select(F.col("id").alias("src"), F.col("calle_id").alias("dst"), F.lit(0).alias("distancia")).distinct())


def calle_mas_cercana(puntos: DataFrame, nodos: DataFrame, radio_m: float = RADIO_BUSQUEDA_M) -> DataFrame:
    """Points with calle_id and ``distancia`` in metres, NULL when nothing is within the radius."""
    c = mas_cercano(puntos, nodos, "plana", radio_m)
    metros = plana_m(F.col("lat"), F.col("lon"), F.col("calle_lat"), F.col("calle_lon"))
    return c.withColumn("distancia", metros).drop("grados")


def registrar_clientes(clientes: DataFrame, nodos: DataFrame, radio_m: float = RADIO_BUSQUEDA_M) -> tuple[DataFrame, DataFrame]:
    """Customers with their road node (the edge to it carries ``distancia``), and the rejected ones."""
    c = calle_mas_cercana(clientes, nodos, radio_m)
    return c.filter("calle_id IS NOT NULL"), c.filter("calle_id IS NULL").select(clientes.columns)


def registrar_repartidores(repartidores: DataFrame, nodos: DataFrame, radio_m: float = RADIO_BUSQUEDA_M) -> DataFrame:
    """Couriers with their current road node, NULL when none is near."""
    c = calle_mas_cercana(repartidores, nodos, radio_m)
    return c.select(*repartidores.columns, F.col("calle_id").alias("calle_actual"))


def ultima_posicion(repartidores: DataFrame, posiciones: DataFrame) -> DataFrame:
    """Couriers moved to their latest reported position (repartidor_id, lat, lon, ts, secuencia)."""
    u = posiciones.groupBy(F.col("repartidor_id").alias("id")).agg(
        F.max_by(F.struct("lat", "lon"), F.struct("ts", "secuencia")).alias("u"))
    resto = [c for c in repartidores.columns if c not in ("id", "lat", "lon")]
    return repartidores.join(repartida(u), "id", "left").select(
        "id", F.coalesce("u.lat", "lat").alias("lat"), F.coalesce("u.lon", "lon").alias("lon"), *resto)
