"""Shortest paths over the road network, from many origins at once.

A label (origin, node) holds the best known cost as a pair compared left to right: (hops,
metres) for the path with fewest segments, (metres, hops) for the shortest one.  Rounds relax
``pasos`` segments in one job, starting only from the labels the last step of the previous
round improved, and write the labels to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.operators import vecinal
from comanda.operators.grafo import simetrica
from comanda.plans.durable import Corte
from comanda.plans.pares import repartida

PASOS = 5
PASO_SAL = 100_000
#: Sums of the same lengths in another order differ by rounding.
HOLGURA = 1e-9


def red(aristas: DataFrame) -> DataFrame:
    """Undirected network (src, dst, distancia): the shortest of parallel segments, no loops."""
    return (simetrica(aristas.select("src", "dst", "distancia")).filter("src <> dst")
            .groupBy("src", "dst").agg(F.min("distancia").alias("distancia")))


@dataclass
class Entorno:
    """Where paths of so many segments can lead: ``lugares(id, lat, lon)`` of the nodes, the segments
    ``vias(src, dst, distancia, ...)`` with the places of their ends, and the degrees of latitude (``alto``) and longitude
    (``ancho``) that a path covers at most.  Cells of that size are numbered by ``celda``."""

    lugares: DataFrame
    vias: DataFrame
    alto: float
    ancho: float

    def celda(self, lado: str = "") -> tuple[Column, Column]:
        return (F.floor(F.col(f"lat{lado}") / self.alto).alias(f"cx{lado}"),
                F.floor(F.col(f"lon{lado}") / self.ancho).alias(f"cy{lado}"))

    def lado(self, c: str) -> DataFrame:
        return repartida(self.lugares.select(F.col("id").alias(c), F.col("lat").alias(f"lat_{c}"), F.col("lon").alias(f"lon_{c}")))

    def pares(self, pares: DataFrame) -> DataFrame:
        """``pares(origen, destino, ...)`` that a path may join: none leads to or from a node without a place, except from
        a node to itself."""
        cerca = ((F.abs(F.col("lat_origen") - F.col("lat_destino")) <= self.alto)
                 & (F.abs(F.col("lon_origen") - F.col("lon_destino")) <= self.ancho))
        return (pares.join(self.lado("origen"), "origen", "left").join(self.lado("destino"), "destino", "left")
                .filter((F.col("origen") == F.col("destino")) | cerca).select(*pares.columns))

    def red(self, origenes: DataFrame) -> DataFrame:
        """The segments that paths from ``origenes(origen)`` may use: those in the cells around the origins' own."""
        corte = Corte(origenes.sparkSession, "red_cercana")
        uno = F.array(*map(F.lit, (-1, 0, 1)))
        # as many rows as there are cells with an origin, not origins
        celdas, _ = corte.guardar(
            repartida(origenes.select("origen").distinct()).join(self.lugares.withColumnRenamed("id", "origen"), "origen")
            .select(*self.celda()).distinct().withColumn("dx", F.explode(uno)).withColumn("dy", F.explode(uno))
            .select((F.col("cx") + F.col("dx")).alias("cx"), (F.col("cy") + F.col("dy")).alias("cy")).distinct())
        e = self.vias.select("src", "dst", "distancia", *self.celda("_src"), *self.celda("_dst"))
        for lado in ("src", "dst"):
            e = e.join(celdas.toDF(f"cx_{lado}", f"cy_{lado}"), [f"cx_{lado}", f"cy_{lado}"], "left_semi")
        return e.select("src", "dst", "distancia")


def entorno(nodos: DataFrame, aristas: DataFrame, saltos: int) -> Entorno | None:
    """How far ``saltos`` segments lead on the map of ``nodos(id, lat, lon)``.

    No segment changes latitude or longitude by more than the one that changes it most, so a path of so many segments
    changes it by at most that many times as much, whatever lengths the segments are given.  A node has a place if all
    its rows name the same one.  None, and nothing is bounded, if a segment leads to a node without a place.
    """
    corte = Corte(nodos.sparkSession, "entorno")
    hay = lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))
    unico = (F.col("a") == F.col("b")) & (F.col("c") == F.col("d"))
    lugares, _ = corte.guardar(
        nodos.groupBy("id").agg(F.min("lat").alias("a"), F.max("lat").alias("b"), F.min("lon").alias("c"), F.max("lon").alias("d"),
                                F.count_if(~(hay("lat") & hay("lon"))).alias("sin"))
        .filter((F.col("sin") == 0) & unico).select("id", F.col("a").cast("double").alias("lat"), F.col("c").cast("double").alias("lon")))
    e = aristas.filter("src <> dst").select("src", "dst", "distancia")
    for lado in ("src", "dst"):
        e = e.join(repartida(lugares.toDF(lado, f"lat_{lado}", f"lon_{lado}")), lado, "left")
    e, _ = corte.guardar(e)
    alto, ancho, sin = e.agg(F.max(F.abs(F.col("lat_src") - F.col("lat_dst"))), F.max(F.abs(F.col("lon_src") - F.col("lon_dst"))),
                             F.count_if(F.col("lat_src").isNull() | F.col("lat_dst").isNull())).first()
    if sin:
        return None
    ancha = lambda x: saltos * (x or 0.0) * (1 + HOLGURA) + HOLGURA
    return Entorno(lugares, e, ancha(alto), ancha(ancho))


def red_cercana(origenes: DataFrame, aristas: DataFrame, nodos: DataFrame | None, saltos: int) -> DataFrame:
    """The segments that paths of ``saltos`` segments from ``origenes(origen)`` may use, or more; all without ``nodos``."""
    cerca = None if nodos is None else entorno(nodos, aristas, saltos)
    return aristas if cerca is None else cerca.red(origenes)


def _pares_y_red(pares: DataFrame, aristas: DataFrame, nodos: DataFrame | None, saltos: int, dos_puntas: bool,
                 corte: Corte) -> tuple[DataFrame, DataFrame]:
    """``pares``, written once, without those too far apart, and the segments around their origins (or both ends)."""
    cerca = None if nodos is None else entorno(nodos, aristas, saltos)
    pares, _ = corte.guardar(pares if cerca is None else cerca.pares(pares))
    if cerca is not None:
        puntas = F.explode(F.array("origen", "destino")) if dos_puntas else F.col("origen")
        aristas = cerca.red(pares.select(puntas.alias("origen")))
    return pares, aristas


@dataclass
class RedContraida:
    """Network whose chains of nodes with two neighbours are single rows.

    ``tramos(src, ini, dst, ult, saltos, distancia)``: a way between two kept nodes by its first and last step, ``ini``
    the node after ``src`` and ``ult`` the one before ``dst``.  ``dentro(src, ini, pos, nodo)``: the nodes between.
    """

    tramos: DataFrame
    dentro: DataFrame


def contraer(aristas: DataFrame, paradas: DataFrame, max_saltos: int | None = None) -> RedContraida:
    """Contracts the network to its junctions, dead ends and ``paradas(id)``.

    A step (src, dst) into a node with two neighbours goes on by one step only.  Every step knows how far it has come
    and the step it has come to, and doubles that in each round by a join on that step, so a chain of n segments takes
    log2(n) rounds and no task holds a chain.  Ways longer than ``max_saltos`` and rings without a kept node, which no
    path between kept nodes uses, are left out.
    """
    corte = Corte(aristas.sparkSession, "contraer")
    r, total = corte.guardar(red(aristas))
    de_paso = (r.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("n"), F.min("dst").alias("x"), F.max("dst").alias("y"))
               .filter("n = 2").join(paradas.select("id").distinct(), "id", "left_anti").select("id", "x", "y"))
    de_paso, _ = corte.guardar(de_paso)
    n = de_paso.withColumnRenamed("id", "dst")
    # (src, dst): the step; (a, b): the step it has come to; fin: b is kept
    pasos = r.join(n, "dst", "left").select(
        "src", "dst", F.col("src").alias("a"), F.col("dst").alias("b"), F.lit(1).cast("bigint").alias("saltos"), "distancia",
        F.col("x").isNull().alias("fin"), F.when(F.col("x") == F.col("src"), F.col("y")).otherwise(F.col("x")).alias("sig"))
    acabados, _ = corte.guardar(pasos.filter("fin").drop("sig"))
    # the first doubling follows the only way on from b; later ones start where b's next step has come to
    abiertos, faltan = corte.guardar(pasos.filter(~F.col("fin")))
    alcance, tope = 1, total if max_saltos is None else max_saltos
    columnas = ["src", "dst", "a", "b", "saltos", "distancia", "fin"]
    while faltan and alcance < min(tope, total + 1):
        # an open step has come to (a, b) and goes on with the step (b, sig)
        todos = abiertos.select(*columnas, "sig").unionByName(acabados.withColumn("sig", F.lit(None).cast("bigint")))
        sigue = todos.select(F.col("src").alias("b"), F.col("dst").alias("sig"), F.col("a").alias("_a"), F.col("b").alias("_b"),
                             F.col("saltos").alias("_s"), F.col("distancia").alias("_d"), F.col("fin").alias("_f"),
                             F.col("sig").alias("_g"))
        dobles, _ = corte.guardar(abiertos.drop("a", "fin").join(sigue, ["b", "sig"]).select(
            "src", "dst", F.col("_a").alias("a"), F.col("_b").alias("b"), (F.col("saltos") + F.col("_s")).alias("saltos"),
            (F.col("distancia") + F.col("_d")).alias("distancia"), F.col("_f").alias("fin"), F.col("_g").alias("sig")))
        acabados = acabados.unionByName(dobles.filter("fin").drop("sig"))
        abiertos = dobles.filter(~F.col("fin"))
        faltan, alcance = abiertos.count(), alcance * 2
    if max_saltos is not None:
        acabados = acabados.filter(F.col("saltos") <= max_saltos)
    acabados, _ = corte.guardar(acabados)
    inicio = acabados.join(de_paso.select(F.col("id").alias("src")), "src", "left_anti")
    tramos = inicio.select("src", F.col("dst").alias("ini"), F.col("b").alias("dst"), F.col("a").alias("ult"), "saltos", "distancia")
    # the step back from a node inside has come to the start of the chain, as many segments away as its place
    dentro = (acabados.join(de_paso.select(F.col("id").alias("src")), "src", "left_semi")
              .select(F.col("b").alias("src"), F.col("a").alias("ini"), F.col("saltos").cast("int").alias("pos"),
                      F.col("src").alias("nodo")))
    return RedContraida(corte.guardar(tramos)[0], corte.guardar(dentro)[0])


def _red_por_nodo(aristas: DataFrame, corte: Corte, paso_sal: int,
                  contraida: RedContraida | None = None) -> tuple[DataFrame, DataFrame]:
    """Network rows to join on (src, sal), and the nodes split into several salts (id, sales).

    A node with more than ``paso_sal`` segments is split; a row carries the salts of its
    target, so the next step knows them.  The zero step from a node to itself (``avanza`` 0)
    carries a label unchanged through a round.
    """
    if contraida is None:
        r = red(aristas).select("src", "dst", F.lit(1).cast("bigint").alias("saltos"), "distancia", F.col("src").alias("ult"))
        r, _ = corte.guardar(r)
    else:
        r = contraida.tramos.filter("src <> dst").drop("ini")
    pesados, _ = corte.guardar(
        r.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("n")).filter(F.col("n") > paso_sal)
        .select("id", F.ceil(F.col("n") / paso_sal).cast("int").alias("sales")))
    for lado in ("src", "dst"):
        s = pesados.select(F.col("id").alias(lado), F.col("sales").alias(f"sales_{lado}"))
        r = r.join(s, lado, "left").withColumn(f"sales_{lado}", F.coalesce(f"sales_{lado}", F.lit(1)))
    anda = r.select("src", "dst", F.pmod(F.xxhash64("dst"), F.col("sales_src")).cast("int").alias("sal"),
                    F.col("sales_dst").alias("sales"), "saltos", "distancia", "ult", F.lit(1).alias("avanza"))
    quieto = r.select("src", "sales_src").distinct().select(
        "src", F.col("src").alias("dst"), F.lit(0).alias("sal"), F.col("sales_src").alias("sales"),
        F.lit(0).cast("bigint").alias("saltos"), F.lit(0.0).alias("distancia"), F.col("src").alias("ult"), F.lit(0).alias("avanza"))
    return corte.guardar_por_clave(anda.unionByName(quieto), ["src", "sal"]), pesados


def _salidas(origenes: DataFrame, pesados: DataFrame) -> DataFrame:
    """Distinct origins as labels of themselves, with their salts."""
    o = origenes.select("origen", F.col("origen").alias("nodo")).distinct()
    s = pesados.select(F.col("id").alias("nodo"), "sales")
    return o.join(s, "nodo", "left").select("origen", "nodo", F.coalesce("sales", F.lit(1)).alias("sales"))


_ETIQUETA = "origen, nodo, sales, l.c1, l.c2, l.pred, l.nuevo"


def _paso(desde: str, donde: str = "") -> str:
    """One network row further from the labels ``desde``, the best label per origin and node."""
    return f"""SELECT {_ETIQUETA} FROM (
        SELECT s.origen, r.dst AS nodo, r.sales, min(struct(s.c1 + r.d1 AS c1, s.c2 + r.d2 AS c2,
               if(r.avanza = 1, r.ult, s.pred) AS pred, r.avanza AS nuevo)) AS l
        FROM (SELECT *, explode(sequence(0, sales - 1)) AS sal FROM ({desde})) s
        JOIN {{r}} r ON s.nodo = r.src AND s.sal = r.sal {donde} GROUP BY s.origen, r.dst, r.sales)"""


def etiquetas(origenes: DataFrame, aristas: DataFrame, por: str = "saltos", max_saltos: int | None = None,
              pasos: int = PASOS, paso_sal: int = PASO_SAL, podar: Poda | None = None, contraida: RedContraida | None = None) -> DataFrame:
    """(origen, nodo, saltos, distancia, pred) for every node that an origin reaches.

    ``por='saltos'`` gives the path of fewest segments and, among those, fewest metres;
    ``por='distancia'`` the path of fewest metres.  Ties go to the smallest predecessor.
    ``podar`` drops labels after each round that are on no best path to a target.  On a ``contraida`` network only
    kept nodes have labels (origins must be kept); ``pred`` is still the node before on the road.
    """
    if por == "distancia" and max_saltos is not None:
        raise ValueError("a hop limit needs por='saltos'")
    spark = origenes.sparkSession
    corte = Corte(spark, "etiquetas")
    saltos, metros = F.col("saltos").cast("double"), F.col("distancia")
    c1, c2 = (saltos, metros) if por == "saltos" else (metros, saltos)
    r, pesados = _red_por_nodo(aristas, corte, paso_sal, contraida)
    r = r.select("src", "dst", "sal", "sales", c1.alias("d1"), c2.alias("d2"), "ult", "avanza")
    donde = "" if contraida is None or max_saltos is None else f"WHERE s.c1 + r.d1 <= {max_saltos}"
    cero = F.lit(0.0)
    mejores, n = corte.avanzar(_salidas(origenes, pesados).select(
        "origen", "nodo", "sales", cero.alias("c1"), cero.alias("c2"), F.col("origen").alias("pred"),
        F.lit(1).alias("nuevo")))
    hechos = 0
    while n and (max_saltos is None or hechos < max_saltos):
        hasta = pasos if max_saltos is None else min(pasos, max_saltos - hechos)
        s = "SELECT * FROM {e} WHERE nuevo = 1"
        for _ in range(hasta):
            s = _paso(s, donde)
        siguen = spark.sql(
            f"""SELECT {_ETIQUETA} FROM (
                  SELECT origen, nodo, sales, min(struct(c1, c2, pred, nuevo)) AS l FROM (
                    SELECT origen, nodo, sales, c1, c2, pred, 0 AS nuevo FROM {{e}}
                    UNION ALL SELECT * FROM ({s})) GROUP BY origen, nodo, sales)""", e=mejores, r=r)
        mejores, _ = corte.avanzar(siguen if podar is None else podar(siguen, mejores))
        n = mejores.filter("nuevo = 1").limit(1).count()
        hechos += hasta
    corte.cerrar()
    s, m = ("c1", "c2") if por == "saltos" else ("c2", "c1")
    return mejores.select("origen", "nodo", F.col(s).cast("int").alias("saltos"), F.col(m).alias("distancia"), "pred")


#: Landmarks of a network.
HITOS = 16


def hitos(aristas: DataFrame, cuantos: int = HITOS) -> DataFrame:
    """(nodo, d0, d1, ...): the metres from each node to ``cuantos`` nodes spread evenly over the ids, null where no path
    leads.  One search of the whole network from all of them."""
    nodos = red(aristas).select("src").distinct()
    partes = [k / max(1, cuantos - 1) for k in range(cuantos)]
    elegidos = nodos.agg(F.percentile_approx("src", F.array(*map(F.lit, partes)), F.lit(10_000)).alias("l")).first()["l"]
    ids = sorted(set(elegidos or []))
    origenes = nodos.filter(F.col("src").isin(ids)).select(F.col("src").alias("origen"))
    et = etiquetas(origenes, aristas, "distancia", pasos=10)
    return et.groupBy("nodo").agg(*[F.max(F.when(F.col("origen") == i, F.col("distancia"))).alias(f"d{k}")
                                    for k, i in enumerate(ids)])


Poda = Callable[[DataFrame, DataFrame], DataFrame]


def poda_por_hitos(pares: DataFrame, h: DataFrame) -> Poda:
    """Drops labels that no target of their origin needs, by the triangle inequality over landmarks.

    To any target t of an origin, the way from a node v is at least as long as the distances of v and t to a landmark
    differ; the targets' distances to each landmark lie in an interval.  The way to the farthest target is at most as
    long as the one over a landmark, or as the best label found at each target so far.  A label beyond that is on no
    best path, ties included.  Origins with a target that no landmark reaches are not bounded.
    """
    corte = Corte(pares.sparkSession, "hitos")
    h, _ = corte.guardar(h)
    ds = [c for c in h.columns if c != "nodo"]
    lado = lambda p, c: h.select(F.col("nodo").alias(c), *[F.col(d).alias(f"{p}{d}") for d in ds])
    sin_fin = F.lit(float("inf"))
    por_hito = F.least(*[F.col(f"o{d}") + F.col(f"t{d}") for d in ds], sin_fin) if ds else sin_fin
    metas = (pares.select("origen", "destino").distinct().join(lado("o", "origen"), "origen", "left")
             .join(lado("t", "destino"), "destino", "left")
             .select("origen", "destino", por_hito.alias("tope"), *[f"t{d}" for d in ds]))
    metas, _ = corte.guardar(metas)
    # an interval counts only if all targets have a distance to its landmark
    todos = lambda f, d: F.when(F.count(f"t{d}") == F.count("*"), f(f"t{d}"))
    intervalos, _ = corte.guardar(metas.groupBy("origen").agg(*[todos(F.min, d).alias(f"a{d}") for d in ds],
                                                              *[todos(F.max, d).alias(f"z{d}") for d in ds]))

    def podar(siguen: DataFrame, antes: DataFrame) -> DataFrame:
        halladas = antes.select("origen", F.col("nodo").alias("destino"), "c1")
        radio = (metas.select("origen", "destino", "tope").join(halladas, ["origen", "destino"], "left")
                 .groupBy("origen").agg(F.max(F.least("tope", "c1")).alias("_radio")))
        # null wherever the node or the targets have no distance to the landmark
        cota = F.greatest(F.lit(0.0), *[F.coalesce(F.greatest(F.col(f"a{d}") - F.col(d), F.col(d) - F.col(f"z{d}")),
                                                   F.lit(0.0)) for d in ds], F.lit(0.0))
        return (siguen.join(intervalos.join(radio, "origen"), "origen").join(h, "nodo", "left")
                .filter(F.col("c1") + cota <= F.col("_radio") * (1 + HOLGURA) + HOLGURA).select(*siguen.columns))

    return podar


def saltos_entre(origenes: DataFrame, aristas: DataFrame, max_saltos: int | None = None,
                 pasos: int = 10, paso_sal: int = PASO_SAL) -> DataFrame:
    """(origen, nodo, saltos) where only the number of segments is asked for.

    The label is one integer, so every round stays in hash aggregation, and the nodes first met
    in the last step of a round are exactly those with that many segments.
    """
    spark = origenes.sparkSession
    corte = Corte(spark, "saltos")
    r, pesados = _red_por_nodo(aristas, corte, paso_sal)
    vistos, n = corte.avanzar(_salidas(origenes, pesados).withColumn("saltos", F.lit(0)))
    hechos = 0
    while n and (max_saltos is None or hechos < max_saltos):
        hasta = pasos if max_saltos is None else min(pasos, max_saltos - hechos)
        s = f"SELECT * FROM {{v}} WHERE saltos = {hechos}"
        for _ in range(hasta):
            s = f"""SELECT s.origen, r.dst AS nodo, r.sales, min(s.saltos + r.avanza) AS saltos
                    FROM (SELECT *, explode(sequence(0, sales - 1)) AS sal FROM ({s})) s
                    JOIN {{r}} r ON s.nodo = r.src AND s.sal = r.sal GROUP BY s.origen, r.dst, r.sales"""
        vistos, _ = corte.avanzar(spark.sql(
            f"""SELECT origen, nodo, sales, min(saltos) AS saltos FROM (SELECT * FROM {{v}} UNION ALL SELECT * FROM ({s}))
                GROUP BY origen, nodo, sales""", v=vistos, r=r))
        hechos += hasta
        n = vistos.filter(F.col("saltos") == hechos).limit(1).count()
    corte.cerrar()
    return vistos.drop("sales")


def caminos(pares: DataFrame, et: DataFrame, pasos: int = 10, contraida: RedContraida | None = None) -> DataFrame:
    """Adds saltos, distancia and ``calles`` (node ids in order) to ``pares(origen, destino, ...)``
    by following predecessors.  Only requested pairs carry a path; unreached pairs are left out.

    Labels of a ``contraida`` network are followed chain by chain, until all paths are at their origin.
    """
    if contraida is not None:
        return _caminos_por_tramos(pares, et, pasos, contraida)
    corte = Corte(pares.sparkSession, "caminos")
    fin = et.select("origen", F.col("nodo").alias("destino"), "saltos", "distancia")
    act = pares.join(fin, ["origen", "destino"]).select(
        *pares.columns, "saltos", "distancia", F.col("destino").alias("_n"), F.array("destino").alias("calles"))
    act, n = corte.avanzar(act)
    if not n:
        return act.drop("_n")
    p = et.select("origen", F.col("nodo").alias("_n"), F.col("pred").alias("_p"))
    faltan = act.agg(F.max("saltos")).first()[0]
    while faltan > 0:
        for _ in range(min(pasos, faltan)):
            act = act.join(p, ["origen", "_n"]).select(
                *pares.columns, "saltos", "distancia", F.col("_p").alias("_n"),
                F.when(F.col("_n") == F.col("origen"), F.col("calles"))
                .otherwise(F.array_prepend("calles", F.col("_p"))).alias("calles"))
        faltan -= pasos
        act, _ = corte.avanzar(act)
    return act.drop("_n")


def _caminos_por_tramos(pares: DataFrame, et: DataFrame, pasos: int, contraida: RedContraida) -> DataFrame:
    corte = Corte(pares.sparkSession, "caminos")
    fin = et.select("origen", F.col("nodo").alias("destino"), "saltos", "distancia")
    act, _ = corte.avanzar(pares.join(fin, ["origen", "destino"]).select(
        *pares.columns, "saltos", "distancia", F.col("destino").alias("_n"), F.array("destino").alias("calles")))
    # a chain read from its far end: the step back (nodo, pred) begins it, its nodes lie in falling place order
    dentro = contraida.dentro.groupBy("src", "ini").agg(F.sort_array(
        F.collect_list(F.struct("pos", "nodo")), asc=False).alias("l"))
    tramo = (contraida.tramos.join(dentro, ["src", "ini"], "left")
             .select(F.col("src").alias("_n"), F.col("ini").alias("pred"), F.col("dst").alias("_p"),
                     F.concat(F.array("dst"), F.coalesce(F.col("l.nodo"), F.expr("array()"))).alias("_t")))
    # only labels other than an origin's own lead back; they are joined once, as a table that all rounds read
    p, _ = corte.guardar(et.filter("nodo <> origen").select("origen", F.col("nodo").alias("_n"), "pred")
                         .join(tramo, ["_n", "pred"]).select("origen", "_n", "_p", "_t"))
    while act.filter(F.col("_n") != F.col("origen")).limit(1).count():
        for _ in range(pasos):
            act = act.join(p, ["origen", "_n"], "left").select(
                *pares.columns, "saltos", "distancia", F.coalesce("_p", "_n").alias("_n"),
                F.when(F.col("_p").isNull(), F.col("calles")).otherwise(F.concat("_t", "calles")).alias("calles"))
        act, _ = corte.avanzar(act)
    return act.drop("_n")


@dataclass
class Trayectos:
    """``pares(origen, destino, saltos, distancia, medio)`` and the half-way labels behind them."""

    pares: DataFrame
    et: DataFrame


def entre_pares(pares: DataFrame, aristas: DataFrame, max_saltos: int, nodos: DataFrame | None = None) -> Trayectos:
    """Path of fewest segments (then metres) for many short-range pairs, met half way.

    Both ends are labelled up to half the limit and joined on the node in between: every
    shortest path has such a node, and the best sum over them is the best path.  On a road
    network that is about a quarter of the labels and half of the rounds of a full search.
    With ``nodos``, pairs that lie too far apart for the limit are not searched.  A node and itself
    need no search: an end of no other pair has its own label only.
    """
    corte = Corte(pares.sparkSession, "pares")
    pares = pares.select("origen", "destino").distinct()
    propios, _ = corte.guardar(pares.filter("origen = destino"))
    pares, aristas = _pares_y_red(pares.filter("origen <> destino"), aristas, nodos, max_saltos, True, corte)
    puntas = pares.select("origen").unionByName(pares.select(F.col("destino").alias("origen"))).distinct()
    cero = F.lit(0).alias("saltos"), F.lit(0.0).alias("distancia")
    suyas = puntas.unionByName(propios.select("origen")).distinct().select(
        "origen", F.col("origen").alias("nodo"), *cero, F.col("origen").alias("pred"))
    et = etiquetas(puntas, aristas, "saltos", (max_saltos + 1) // 2).filter("origen <> nodo").unionByName(suyas)
    ida = et.select("origen", F.col("nodo").alias("medio"), F.col("saltos").alias("sa"), F.col("distancia").alias("da"))
    vuelta = et.select(F.col("origen").alias("destino"), F.col("nodo").alias("medio"), F.col("saltos").alias("sb"),
                       F.col("distancia").alias("db"))
    saltos = F.col("sa") + F.col("sb")
    mejor = (pares.join(ida, "origen").join(vuelta, ["destino", "medio"]).filter(saltos <= max_saltos)
             .groupBy("origen", "destino")
             .agg(F.min(F.struct(saltos.alias("saltos"), (F.col("da") + F.col("db")).alias("distancia"), "medio"))
                  .alias("m")).select("origen", "destino", "m.*"))
    mejor = mejor.unionByName(propios.select("origen", "destino", *cero, F.col("origen").alias("medio")))
    return Trayectos(corte.guardar(mejor)[0], et)


def caminos_de_trayectos(pedidos: DataFrame, t: Trayectos) -> DataFrame:
    """``pedidos(origen, destino, ...)`` with ``calles``: the way to the middle node and on from it."""
    p = pedidos.join(t.pares.select("origen", "destino", "medio"), ["origen", "destino"])
    mitades = p.select("origen", F.col("medio").alias("destino")).unionByName(
        p.select(F.col("destino").alias("origen"), F.col("medio").alias("destino"))).distinct()
    c = caminos(mitades, t.et)
    ida = c.select("origen", F.col("destino").alias("medio"), F.col("calles").alias("_ida"))
    vuelta = c.select(F.col("origen").alias("destino"), F.col("destino").alias("medio"), F.col("calles").alias("_vuelta"))
    resto = F.slice(F.reverse("_vuelta"), F.lit(2), F.size("_vuelta"))
    return (p.join(ida, ["origen", "medio"]).join(vuelta, ["destino", "medio"])
            .select(*pedidos.columns, F.concat("_ida", resto).alias("calles")))


def _puntos(rutas: DataFrame, clave: list[str], nodos: DataFrame) -> DataFrame:
    return (rutas.select(*clave, F.posexplode("calles").alias("_p", "id"))
            .join(nodos.select("id", "lat", "lon"), "id"))


def con_coordenadas(rutas: DataFrame, nodos: DataFrame, clave: list[str]) -> DataFrame:
    """Adds ``coordenadas`` (lat, lon of each node of the path, at most the hop limit long)."""
    c = (_puntos(rutas, clave, nodos).groupBy(*clave)
         .agg(F.sort_array(F.collect_list(F.struct("_p", "lat", "lon"))).alias("c"))
         .select(*clave, F.transform("c", lambda x: F.struct(x["lat"].alias("lat"), x["lon"].alias("lon")))
                 .alias("coordenadas")))
    return rutas.join(c, clave)


def ruta_mas_corta(pares: DataFrame, aristas: DataFrame, max_saltos: int = 20, nodos: DataFrame | None = None) -> DataFrame:
    """Path of fewest segments per (origen, destino): distancia, num_calles and calles.  With ``nodos``, only the map around
    the origins is searched."""
    pares, aristas = _pares_y_red(pares, aristas, nodos, max_saltos, False, Corte(pares.sparkSession, "ruta"))
    et = etiquetas(pares.select("origen"), aristas, "saltos", max_saltos)
    return caminos(pares, et).withColumnRenamed("saltos", "num_calles")


def ruta_por_tramos(pares: DataFrame, aristas: DataFrame, max_saltos: int = 100, nodos: DataFrame | None = None) -> DataFrame:
    """The same paths as ``ruta_mas_corta``, ties included, over the contracted network: the number of rounds follows
    the chains on a path and not its segments.  Origins and targets are kept nodes.

    A node inside a chain has one way to either end, so the last step into a kept node decides its chain, and the
    smallest predecessor there is the smallest one on the full network.  With ``nodos``, only the map around the origins
    is contracted and searched.
    """
    pares, aristas = _pares_y_red(pares, aristas, nodos, max_saltos, False, Corte(pares.sparkSession, "ruta"))
    paradas = pares.select(F.explode(F.array("origen", "destino")).alias("id"))
    c = contraer(aristas, paradas, max_saltos)
    et = etiquetas(pares.select("origen"), aristas, "saltos", max_saltos, contraida=c)
    return caminos(pares, et, contraida=c).withColumnRenamed("saltos", "num_calles")


def ruta_menor_distancia(pares: DataFrame, aristas: DataFrame) -> DataFrame:
    """Path of fewest metres per (origen, destino).  On a network that fits one task each origin is searched in one, as far
    as its targets lie; on a larger one in rounds, which go no further than landmarks say they must."""
    corte = Corte(pares.sparkSession, "menor")
    r, n = corte.guardar(red(aristas))
    if vecinal.cabe(pares, r, n):
        pares, m = corte.guardar(pares)
        return vecinal.caminos_mas_cortos(pares, r, m).withColumnRenamed("saltos", "num_calles")
    podar = poda_por_hitos(pares, hitos(aristas))
    et = etiquetas(pares.select("origen"), aristas, "distancia", pasos=10, podar=podar)
    return caminos(pares, et).withColumnRenamed("saltos", "num_calles")


def pasos_de_ruta(rutas: DataFrame, clave: list[str], nodos: DataFrame, aristas: DataFrame,
                  primeros: int | None = 10) -> DataFrame:
    """Steps of each path: node, coordinates, and the street taken next; the last node has the
    street ``DESTINO`` and distance 0.  ``primeros`` keeps that many steps per path."""
    calles = F.col("calles") if primeros is None else F.slice("calles", 1, primeros + 1)
    # the shortest of parallel segments, in either direction, is the one the path uses
    tramo = (simetrica(aristas.select("src", "dst", "distancia", "nombre")).groupBy("src", "dst")
             .agg(F.min(F.struct("distancia", "nombre")).alias("t")))
    nodo = (rutas.select(*clave, F.size("calles").alias("_n"), F.posexplode(calles).alias("_p", "src"),
                         calles.alias("_c"))
            .withColumn("dst", F.try_element_at("_c", F.col("_p") + 2)))
    if primeros is not None:
        nodo = nodo.filter(F.col("_p") < primeros)
    fin = F.col("_p") == F.col("_n") - 1
    return (nodo.join(nodos.select(F.col("id").alias("src"), "lat", "lon"), "src")
            .join(tramo, ["src", "dst"], "left")
            .select(*clave, (F.col("_p") + 1).alias("paso"), F.col("src").alias("nodo_id"),
                    F.col("lat").alias("latitud"), F.col("lon").alias("longitud"),
                    F.when(fin, F.lit("DESTINO")).otherwise(F.col("t.nombre")).alias("calle"),
                    F.when(fin, F.lit(0.0)).otherwise(F.col("t.distancia")).alias("distancia_m")))


def detalle_de_ruta(rutas: DataFrame, clave: list[str], nodos: DataFrame, aristas: DataFrame) -> DataFrame:
    """One row per path: segment count, node list and street list."""
    p = pasos_de_ruta(rutas, clave, nodos, aristas, None)
    l = (p.groupBy(*clave).agg(F.sort_array(F.collect_list(F.struct(
        "paso", "nodo_id", "latitud", "longitud", "calle", "distancia_m"))).alias("l")))
    return l.select(
        *clave, (F.size("l") - 1).alias("total_segmentos"),
        F.transform("l", lambda x: F.struct(x["nodo_id"].alias("osm_id"), x["latitud"].alias("lat"),
                                            x["longitud"].alias("lon"))).alias("nodos"),
        F.transform(F.slice("l", F.lit(1), F.size("l") - 1), lambda x: F.struct(
            x["calle"].alias("nombre"), x["distancia_m"].alias("distancia"))).alias("calles"))


def resumen_de_ruta(rutas: DataFrame, nodos: DataFrame, clave: list[str], kmh: float = 30.0) -> DataFrame:
    """Map summary per path: first and last point, km, minutes and segments."""
    ext = rutas.select(*clave, "distancia", "num_calles", F.element_at("calles", 1).alias("a"),
                       F.element_at("calles", -1).alias("b"))
    for n, c in (("a", "origen"), ("b", "destino")):
        ext = ext.join(nodos.select(F.col("id").alias(n), F.col("lat").alias(f"lat_{c}"),
                                    F.col("lon").alias(f"lon_{c}")), n)
    m = F.col("distancia")
    return ext.select(*clave, "lat_origen", "lon_origen", "lat_destino", "lon_destino",
                      (F.round(m / 10) / 100).alias("distancia_km"),
                      (F.round(m * 0.6 / kmh) / 10).alias("tiempo_estimado_min"),
                      F.col("num_calles").alias("segmentos"))


# ---- reach ---------------------------------------------------------------------------------

def alcance(nodos: DataFrame, aristas: DataFrame, inicios: int = 100, max_saltos: int = 5) -> DataFrame:
    """Connectivity probe: distinct nodes within ``max_saltos`` of the first ``inicios`` nodes (those
    without edges do not count), and how many starts have a path."""
    r = red(aristas).select("src", "dst")
    primeros = nodos.select("id").orderBy("id").limit(inicios)
    con_via = primeros.join(r.select(F.col("src").alias("id")).distinct(), "id", "left_semi")
    corte = Corte(nodos.sparkSession, "alcance")
    inicio, total = corte.avanzar(con_via)
    visto = inicio
    for _ in range(max_saltos):
        # every node with an edge comes back to itself over that edge, so it stays reached
        llega = visto.join(r, visto["id"] == r["src"]).select(F.col("dst").alias("id"))
        visto, _ = corte.avanzar(llega.unionByName(visto).distinct())
    return visto.agg(F.count("*").alias("conectadas")).select("conectadas", F.lit(total).cast("bigint").alias("total"))


# ---- restaurant x customer analyses --------------------------------------------------------

def rutas_entre_anclas(restaurantes: DataFrame, clientes: DataFrame, aristas: DataFrame,
                       max_saltos: int = 100) -> DataFrame:
    """Segments between the road nodes of every restaurant and every customer that a path
    joins: (restaurante_id, restaurante, cliente_id, cliente, segmentos).  Anchors are
    (id, nombre, osm_node_id); anchors at one node share its labels."""
    et = saltos_entre(restaurantes.select(F.col("osm_node_id").alias("origen")), aristas, max_saltos)
    r = restaurantes.select(F.col("id").alias("restaurante_id"), F.col("nombre").alias("restaurante"),
                            F.col("osm_node_id").alias("origen"))
    c = clientes.select(F.col("id").alias("cliente_id"), F.col("nombre").alias("cliente"),
                        F.col("osm_node_id").alias("nodo"))
    return (et.select("origen", "nodo", F.col("saltos").alias("segmentos")).join(r, "origen").join(c, "nodo")
            .select("restaurante_id", "restaurante", "cliente_id", "cliente", "segmentos"))


#: Anchors of one block: a pair of blocks is a join key, of at most about the square of this many pairs.
ANCLAS_POR_BLOQUE = 1_000


def pares_de_bloques(izq: DataFrame, der: DataFrame, bloque: int = ANCLAS_POR_BLOQUE) -> DataFrame:
    """Every row of ``izq`` with every row of ``der``, whatever their number.

    Both sides are dealt into blocks by hash; each row goes to all blocks of the other side, and the pairs are
    an equality join on (block, block).  A side is copied once per block of the other one, and no list of it is
    ever one value.
    """
    n, m = (_bloques(df, bloque) for df in (izq, der))
    de = lambda df, k: F.pmod(F.xxhash64(*df.columns), F.lit(k)).cast("int")
    return _cruzar(izq.withColumn("_a", de(izq, n)), der.withColumn("_b", de(der, m)).withColumn("_a", _todos(n)), m)


def _bloques(df: DataFrame, bloque: int) -> int:
    return max(1, -(-df.count() // bloque))


def _todos(k: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(k - 1)))


def _cruzar(izq: DataFrame, der: DataFrame, m: int) -> DataFrame:
    """``izq`` with its block ``_a`` against ``der``, which has a row for each ``_a`` and its block ``_b`` of ``m``."""
    return izq.withColumn("_b", _todos(m)).join(repartida(der), ["_a", "_b"]).drop("_a", "_b")


def matriz_conectividad(restaurantes: DataFrame, clientes: DataFrame, aristas: DataFrame, max_saltos: int = 100,
                        bloque: int = ANCLAS_POR_BLOQUE, nodos: DataFrame | None = None) -> DataFrame:
    """Every restaurant with every customer: segments (0 without a path) and state.

    The matrix is the result, so it grows with the product of both.  It is dealt out by pairs of blocks, and a customer
    brings to each block of restaurants the segments to the road nodes of that block, so a pair is made where both
    meet and is never shuffled.  Rows of one id stand at each other's nodes too.
    """
    corte = Corte(restaurantes.sparkSession, "matriz")
    r, c = restaurantes.select("id", "nombre", "osm_node_id"), clientes.select("id", "nombre", "osm_node_id")
    (r, _), (c, _) = corte.guardar(r), corte.guardar(c)
    o = r.select(F.col("osm_node_id").alias("origen"))
    et, _ = corte.guardar(saltos_entre(o, red_cercana(o, aristas, nodos, max_saltos), max_saltos))
    n, m = _bloques(r, bloque), _bloques(c, bloque)
    # restaurants of one node share a block, those of a crowded node as many blocks as they fill
    suyos = r.groupBy("id").agg(F.array_sort(F.collect_list("osm_node_id")).alias("_o"))
    izq = r.join(repartida(suyos), "id", "left").select("id", "nombre", F.coalesce("_o", F.array().cast("array<bigint>")).alias("origenes"))
    partes = izq.groupBy("origenes").agg(F.ceil(F.count("*") / bloque).alias("_p"))
    izq, _ = corte.guardar(izq.join(repartida(partes), "origenes").select(
        F.col("id").alias("restaurante_id"), F.col("nombre").alias("restaurante"), "origenes",
        F.pmod(F.xxhash64("origenes", F.pmod(F.xxhash64("id", "nombre"), F.col("_p"))), F.lit(n)).cast("int").alias("_a")))
    en = izq.select(F.explode("origenes").alias("origen"), "_a").distinct()
    mapas = (et.select("origen", F.col("nodo").alias("osm_node_id"), "saltos")
             .join(repartida(c.select("id", "osm_node_id")), "osm_node_id").join(repartida(en), "origen").groupBy("id", "_a", "origen").agg(F.collect_list("saltos").alias("s")).groupBy("id", "_a")
             .agg(F.map_from_entries(F.collect_list(F.struct("origen", "s"))).alias("mapa")))
    der = (c.withColumn("_b", F.pmod(F.xxhash64("id", "nombre"), F.lit(m)).cast("int")).withColumn("_a", _todos(n))
           .join(repartida(mapas), ["id", "_a"], "left")
           .select(F.col("id").alias("cliente_id"), F.col("nombre").alias("cliente"), "mapa", "_a", "_b"))
    nada = F.array().cast("array<int>")
    segmentos = F.flatten(F.transform("origenes", lambda o: F.coalesce(F.try_element_at("mapa", o), nada)))
    return (_cruzar(izq, der, m)
            .select("restaurante_id", "restaurante", "cliente_id", "cliente", F.explode_outer(segmentos).alias("segmentos"))
            .select("restaurante_id", "restaurante", "cliente_id", "cliente",
                    F.coalesce("segmentos", F.lit(0)).alias("segmentos"),
                    F.when(F.col("segmentos").isNotNull(), "CONECTADO").otherwise("SIN RUTA").alias("estado")))


def alcances(restaurantes: DataFrame, clientes: DataFrame, aristas: DataFrame, max_saltos: int = 100,
             nodos: DataFrame | None = None) -> DataFrame:
    """What the reports on all joined pairs need: (origen, nodo, segmentos, nr, nc), one row for each road node with
    customers that a road node with restaurants reaches, with the number of both.  No pair of a restaurant and a
    customer is ever a row, however many share a node.  Anchors are (id, nombre, osm_node_id).  With ``nodos``, only the map
    around the restaurants is searched."""
    corte = Corte(restaurantes.sparkSession, "alcances")
    en = lambda df, n: df.groupBy(F.col("osm_node_id").alias("nodo")).agg(F.count("*").alias(n))
    r, c = en(restaurantes, "nr").withColumnRenamed("nodo", "origen"), en(clientes, "nc")
    r, _ = corte.guardar(r)
    o = r.select("origen")
    et = saltos_entre(o, red_cercana(o, aristas, nodos, max_saltos), max_saltos).withColumnRenamed("saltos", "segmentos")
    return corte.guardar(
        et.join(r, "origen").join(c, "nodo").select("origen", "nodo", "segmentos", "nr", "nc"))[0]


def rutas_extremas(alc: DataFrame, restaurantes: DataFrame, clientes: DataFrame, k: int = 5,
                   largas: bool = False) -> DataFrame:
    """The ``k`` shortest (or longest) routes, ties by restaurant and customer id.

    The histogram of routes by length tells at which length the kth one is.  Of the rows of one length, only the k with
    the smallest ids can hold one of the k, and of each of their two places only the k smallest ids.
    """
    por_largo = alc.groupBy("segmentos").agg(F.sum(F.col("nr") * F.col("nc")).alias("n"))
    orden = F.desc("segmentos") if largas else F.asc("segmentos")
    # at most one row a length up to the hop limit
    corridas = por_largo.withColumn("antes", F.sum("n").over(W.orderBy(orden)) - F.col("n")).filter(F.col("antes") < k)
    de = lambda df, c, x: (df.select(F.col("osm_node_id").alias(c), F.struct("id", "nombre").alias(x))
                           .withColumn("_k", F.row_number().over(W.partitionBy(c).orderBy(f"{x}.id", f"{x}.nombre")))
                           .filter(F.col("_k") <= k).drop("_k"))
    r, c = de(restaurantes, "origen", "r"), de(clientes, "nodo", "c")
    menor = lambda df, x: df.groupBy(df.columns[0]).agg(F.min(f"{x}.id").alias(f"_{x}"))
    filas = (alc.join(F.broadcast(corridas.select("segmentos")), "segmentos")
             .join(menor(r, "r"), "origen").join(menor(c, "c"), "nodo")
             .withColumn("_k", F.row_number().over(W.partitionBy("segmentos").orderBy("_r", "_c", "origen", "nodo")))
             .filter(F.col("_k") <= k))
    return (filas.join(r, "origen").join(c, "nodo").orderBy(orden, "r.id", "c.id").limit(k)
            .select(F.col("r.nombre").alias("restaurante"), F.col("c.nombre").alias("cliente"), "segmentos"))


def segmentos_por_restaurante(alc: DataFrame, restaurantes: DataFrame) -> DataFrame:
    """Mean, least and most segments of the routes of each restaurant that has any."""
    por_nodo = alc.groupBy(F.col("origen").alias("osm_node_id")).agg(
        F.round(F.sum(F.col("segmentos") * F.col("nc")) / F.sum("nc"), 2).alias("segmentos_promedio"),
        F.min("segmentos").alias("min_segmentos"), F.max("segmentos").alias("max_segmentos"))
    return (restaurantes.join(por_nodo, "osm_node_id").orderBy("segmentos_promedio", "id")
            .select(F.col("nombre").alias("restaurante"), "segmentos_promedio", "min_segmentos", "max_segmentos"))


def promedio_segmentos(alc: DataFrame, anclas: DataFrame, lado: str) -> DataFrame:
    """Mean segments per ``restaurante`` (most central first) or per ``cliente`` (most accessible)."""
    nodo, peso = ("origen", "nc") if lado == "restaurante" else ("nodo", "nr")
    por_nodo = alc.groupBy(F.col(nodo).alias("osm_node_id")).agg(
        F.round(F.sum(F.col("segmentos") * F.col(peso)) / F.sum(peso), 2).alias("promedio_segmentos"))
    return (anclas.join(por_nodo, "osm_node_id").orderBy("promedio_segmentos", "id")
            .select(F.col("nombre").alias(lado), "promedio_segmentos"))


def prueba_conectividad(alc: DataFrame, restaurantes: DataFrame, clientes: DataFrame) -> DataFrame:
    """Joined pairs against all pairs, both from counts."""
    total = restaurantes.agg(F.count("*")).scalar() * clientes.agg(F.count("*")).scalar()
    return (alc.agg(F.coalesce(F.sum(F.col("nr") * F.col("nc")), F.lit(0)).alias("rutas_exitosas"))
            .select("rutas_exitosas", total.alias("rutas_totales")))
