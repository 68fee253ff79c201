"""Communities of a weighted network by modularity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.operators.rank import componentes
from comanda.plans.durable import Corte
from comanda.plans.pares import PARTE_LLENA, unir_por_clave

#: Rounds of moves without a rise of modularity after which a level is settled.
RONDAS_QUIETAS = 4
#: Rows of a network that one task moves and contracts to the end: about 400 MB of its memory.
FILAS_EN_TAREA = 3_000_000


def _por_exacto(a, b):
    return a.cast("decimal(19,0)") * b.cast("decimal(19,0)")


def _mover(g: DataFrame, filas: int, doble: int, minimo: int) -> tuple[DataFrame, int, int]:
    """Local moving on one level: (id, com, n) of the best state seen, its modularity times ``doble``², its nodes.

    ``g(a, b, w)`` has both directions of every edge and one row per loop.  In a round every node weighs the communities
    of its neighbours against its own by the exact whole-number gain; ties stay, or go to the smallest label.  The half
    of the nodes that a hash of id and round names moves, so two neighbours do not swap places for ever.  Since moves of
    one round can spoil each other, the state with the highest modularity is kept along.
    """
    spark = g.sparkSession
    corte, corte_con = Corte(spark, "mover"), Corte(spark, "mover_con")
    lazo = F.when(F.col("a") == F.col("b"), F.col("w")).otherwise(F.lit(0))
    nodos, n_nodos = corte.guardar(g.groupBy(F.col("a").alias("id")).agg(
        F.sum("w").alias("k"), F.count("*").alias("n"), F.sum(lazo).alias("lazo")))
    lazos = nodos.agg(F.sum("lazo")).first()[0]
    umbral = filas / PARTE_LLENA
    e = unir_por_clave(g.filter("a <> b"), nodos.select(F.col("id").alias("a"), F.col("k").alias("ka"), "n"), "a", filas)
    llenos = F.broadcast(nodos.filter(F.col("n") > umbral).select(F.col("id").alias("b")))
    # edges into full nodes lie apart; the others are never shuffled again
    hacia_llenos, _ = corte.guardar(e.join(llenos, "b", "left_semi"), contar=False)
    hacia_resto = corte.guardar_por_clave(e.join(llenos, "b", "left_anti"), ["b"])

    estado = nodos.select("id", "k", "n", F.col("id").alias("com"), F.col("id").alias("mejor"))
    q_mejor, quietas, ronda = None, 0, 0
    while True:
        total = estado.groupBy("com").agg(F.sum("k").alias("tot"), F.count("*").alias("n"))
        con, _ = corte_con.avanzar(unir_por_clave(estado.withColumnRenamed("n", "grado"), total, "com", n_nodos), contar=False)
        fin = con.select(F.col("id").alias("b"), "com", "tot", "grado")
        vecinos = (hacia_resto.join(fin.drop("grado"), "b")
                   .unionByName(hacia_llenos.join(F.broadcast(fin.filter(F.col("grado") > umbral).drop("grado")), "b")))
        nada = F.lit(None).cast("bigint")
        opciones = (vecinos.select(F.col("a").alias("id"), "com", "tot", F.col("ka").alias("k"), "w",
                                   nada.alias("grado"), nada.alias("mejor"))
                    .unionByName(con.select("id", "com", "tot", "k", F.lit(0).cast("bigint").alias("w"), "grado", "mejor"))
                    .groupBy("id", "com").agg(F.sum("w").alias("w"), F.max("tot").alias("tot"), F.max("k").alias("k"),
                                              F.max("grado").alias("grado"), F.max("mejor").alias("mejor")))
        propia = F.col("mejor").isNotNull()
        otros = F.col("tot") - F.when(propia, F.col("k")).otherwise(F.lit(0))
        gana = _por_exacto(F.lit(doble), F.col("w")) - _por_exacto(F.col("k"), otros)
        elegido = (opciones.withColumn("gana", gana).groupBy("id").agg(
            F.max(F.struct("gana", (-F.col("com")).alias("menos"))).alias("m"),
            F.max(F.when(propia, F.col("gana"))).alias("actual"), F.max(F.when(propia, F.col("com"))).alias("antes"),
            F.max(F.when(propia, F.col("w"))).alias("dentro"), F.max("k").alias("k"),
            F.max("grado").alias("n"), F.max("mejor").alias("mejor")))
        quiere = F.col("m.gana") > F.col("actual")
        turno = F.pmod(F.xxhash64("id", F.lit(ronda)), F.lit(2)) == 0
        hecho, _ = corte.avanzar(elegido.select(
            "id", "k", "n", "mejor", "antes", "dentro", quiere.alias("quiere"),
            F.when(quiere & turno, -F.col("m.menos")).otherwise(F.col("antes")).alias("com")), contar=False)
        dentro, quieren, cuadrados = (
            hecho.groupBy("antes").agg(F.sum("dentro").alias("dentro"), F.count_if("quiere").alias("quieren"), F.sum("k").alias("tot"))
            .agg(F.sum("dentro"), F.sum("quieren"), F.sum(_por_exacto(F.col("tot"), F.col("tot")))).first())
        q = doble * (dentro + lazos) - int(cuadrados)
        sube = q_mejor is None or q > q_mejor
        quietas = 0 if q_mejor is None or q - q_mejor > minimo else quietas + 1
        q_mejor = q if sube else q_mejor
        estado = hecho.select("id", "k", "n", "com", F.col("antes" if sube else "mejor").alias("mejor"))
        ronda += 1
        if not quieren or quietas >= RONDAS_QUIETAS:
            break
    corte.cerrar()
    return estado.select("id", F.col("mejor").alias("com"), "n"), q_mejor, n_nodos


def _contraer(g: DataFrame, filas: int, mapa: DataFrame) -> DataFrame:
    """The network of communities: weights between them, and inside as loops."""
    por_b = (unir_por_clave(g, mapa.select(F.col("id").alias("b"), F.col("com").alias("cb"), "n"), "b", filas)
             .groupBy("a", "cb").agg(F.sum("w").alias("w")))
    return (unir_por_clave(por_b, mapa.select(F.col("id").alias("a"), F.col("com").alias("ca"), "n"), "a", filas)
            .groupBy(F.col("ca").alias("a"), F.col("cb").alias("b")).agg(F.sum("w").alias("w")))


def _xxhash64(ids: np.ndarray, ronda: int) -> np.ndarray:
    """Spark's ``xxhash64(id, ronda)`` of a bigint and an int."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    gira = lambda x, r: (x << np.uint64(r)) | (x >> np.uint64(64 - r))

    def mezcla(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return h ^ (h >> np.uint64(32))

    with np.errstate(over="ignore"):
        h = np.uint64(42) + p5 + np.uint64(8)
        h = mezcla(gira(h ^ (gira(ids.astype(np.int64).view(np.uint64) * p2, 31) * p1), 27) * p1 + p4)
        return mezcla(gira((h + p5 + np.uint64(4)) ^ (np.uint64(ronda) * p1), 23) * p2 + p3)


def _mover_en_memoria(ids: np.ndarray, a: np.ndarray, b: np.ndarray, w: np.ndarray, doble: int, minimo: int) -> tuple[np.ndarray, int]:
    """``_mover`` on the places of ``ids`` (in order) instead of ids: the community of each, and its modularity."""
    n = len(ids)
    suma = lambda de, x: np.bincount(de, x, n).astype(np.int64)  # noqa: E731  (exact: sums stay below 2^31)
    k, lazos = suma(a, w), int(w[a == b].sum())
    fuera = a != b
    a, b, w = a[fuera], b[fuera], w[fuera]
    todos = np.arange(n)
    com, mejor, q_mejor, quietas, ronda = todos, todos, None, 0, 0
    pesos = np.concatenate([w, np.zeros(n, np.int64)])
    while True:
        tot = suma(com, k)
        # one row per node and community around it, its own one among them, by node and community
        clave = np.concatenate([a * n + com[b], todos * n + com])
        orden = np.argsort(clave, kind="stable")
        clave = clave[orden]
        inicio = np.flatnonzero(np.concatenate([[True], clave[1:] != clave[:-1]]))
        peso = np.add.reduceat(pesos[orden], inicio)
        nodo, otra = np.divmod(clave[inicio], n)
        propia = otra == com[nodo]
        gana = doble * peso - k[nodo] * (tot[otra] - np.where(propia, k[nodo], 0))
        maximo = np.maximum.reduceat(gana, np.flatnonzero(np.concatenate([[True], nodo[1:] != nodo[:-1]])))
        # of equal gains the smallest label: written last
        igual = np.flatnonzero(gana == maximo[nodo])[::-1]
        elegida = np.empty(n, np.int64)
        elegida[nodo[igual]] = otra[igual]
        quiere = maximo > gana[propia]
        q = doble * (int(peso[propia].sum()) + lazos) - int((tot * tot).sum())
        quietas = 0 if q_mejor is None or q - q_mejor > minimo else quietas + 1
        if q_mejor is None or q > q_mejor:
            q_mejor, mejor = q, com
        com = np.where(quiere & (_xxhash64(ids, ronda) & np.uint64(1) == 0), elegida, com)
        ronda += 1
        if not quiere.any() or quietas >= RONDAS_QUIETAS:
            return mejor, q_mejor


def _niveles_en_memoria(a: np.ndarray, b: np.ndarray, w: np.ndarray, doble: int, minimo: int,
                        q_antes: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, com, n) of the nodes of a network after this and all further levels, as ``comunidades`` goes through them."""
    ids, a = np.unique(a, return_inverse=True)
    b = np.searchsorted(ids, b)
    primeros, grado, hasta = ids, np.bincount(a, minlength=len(ids)), np.arange(len(ids))
    com_de = ids
    while True:
        n = len(ids)
        com, q = _mover_en_memoria(ids, a, b, w, doble, minimo)
        quedan = np.unique(com)
        lugar = np.searchsorted(quedan, com)
        hasta, com_de = lugar[hasta], ids[quedan]
        if len(quedan) == n or (q_antes is not None and q <= q_antes):
            return primeros, com_de[hasta], grado
        q_antes = q
        m = len(quedan)
        clave, de = np.unique(lugar[a] * m + lugar[b], return_inverse=True)
        a, b = np.divmod(clave, m)
        w = np.bincount(de, w, len(clave)).astype(np.int64)
        ids = com_de


def _en_una_tarea(g: DataFrame, doble: int, minimo: int, q_antes: int | None) -> DataFrame:
    """(id, com, n) as ``_mover`` gives it, after this and all further levels of a network that fits one task.  A round is
    a few array operations there, not some ten jobs; moves, ties and order are the same."""

    def ir(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(lotes)
        if t.num_rows:
            yield pa.record_batch(dict(zip(("id", "com", "n"), _niveles_en_memoria(
                *(t[c].to_numpy() for c in ("a", "b", "w")), doble, minimo, q_antes))))

    return g.select("a", "b", "w").coalesce(1).mapInArrow(ir, "id bigint, com bigint, n bigint")


def comunidades(nodos: DataFrame, aristas: DataFrame, mejora: float = 1e-6) -> DataFrame:
    """Communities (id, comunidad = smallest member) of ``nodos(id)`` that raise modularity, with edges
    ``aristas(src, dst[, peso])`` taken as undirected and parallel edges added up.

    Nodes move between the communities of their neighbours until no round raises modularity by more than ``mejora``,
    communities become nodes of a smaller network, and so on until nothing is joined any more.  Once a network has at most
    ``FILAS_EN_TAREA`` rows, one task goes through its rounds and levels.  A community that falls
    into parts without an edge between them is its parts, which never lowers modularity; so none spans two components.

    ``peso`` is a positive whole number, 1 without the column.  Edges from a node to itself or with a null end or
    weight do not count; ends that are not in ``nodos`` take part but are not returned.  A node without edges is its own
    community.  Repeated nodes are repeated rows.  Sums are whole numbers: the result depends on no partitioning.
    """
    spark = nodos.sparkSession
    corte = Corte(spark, "comunidades")
    peso = F.col("peso").cast("bigint") if "peso" in aristas.columns else F.lit(1).cast("bigint")
    src, dst = F.col("src").cast("bigint"), F.col("dst").cast("bigint")
    base, filas_base = corte.guardar(
        aristas.filter((src != dst) & (peso > 0))
        .select(F.inline(F.array(F.struct(src.alias("a"), dst.alias("b"), peso.alias("w")),
                                 F.struct(dst.alias("a"), src.alias("b"), peso.alias("w")))))
        .groupBy("a", "b").agg(F.sum("w").alias("w")))
    if not filas_base:
        return nodos.select("id", F.col("id").alias("comunidad"))
    doble = base.agg(F.sum("w")).first()[0]
    g, filas, en, q_antes = base, filas_base, None, None
    while True:
        # in a task gains are whole numbers of 64 bits
        cabe, minimo = filas <= FILAS_EN_TAREA and doble < 1 << 31, int(mejora * doble * doble)
        mapa, q, n = (_en_una_tarea(g, doble, minimo, q_antes), None, None) if cabe else _mover(g, filas, doble, minimo)
        if en is None:
            en, n_en = corte.avanzar(mapa)
        else:
            cuenta = en.groupBy(F.col("com").alias("id")).agg(F.count("*").alias("n"))
            nuevo = mapa.drop("n").withColumnRenamed("com", "com2").join(cuenta, "id").withColumnRenamed("id", "com")
            en, _ = corte.avanzar(unir_por_clave(en, nuevo, "com", n_en).select("id", F.col("com2").alias("com"), "n"))
        if cabe:
            break
        quedan = mapa.select("com").distinct().count()
        if quedan == n or (q_antes is not None and q <= q_antes):
            break
        q_antes = q
        g, filas = corte.guardar(_contraer(g, filas, mapa))
    lado = lambda x: en.select(F.col("id").alias(x), F.col("com").alias(f"c{x}"), "n")
    una_vez = unir_por_clave(base.filter("a < b"), lado("a"), "a", filas_base)
    dentro = (unir_por_clave(una_vez, lado("b"), "b", filas_base)
              .filter("ca = cb").select(F.col("a").alias("src"), F.col("b").alias("dst")))
    return componentes(nodos, dentro)


def calidad(grupos: DataFrame, aristas: DataFrame) -> DataFrame:
    """One row per community of ``grupos(id, comunidad)``: members, weight of the edges inside and of those that leave,
    and what it adds to modularity (the sum over all communities is the modularity).  Counts edges as ``comunidades``
    does; edges with an end outside ``grupos`` are left out."""
    peso = F.col("peso").cast("bigint") if "peso" in aristas.columns else F.lit(1).cast("bigint")
    corte = Corte(aristas.sparkSession, "calidad")
    e, filas = corte.guardar(aristas.filter((F.col("src") != F.col("dst")) & (peso > 0))
                             .groupBy("src", "dst").agg(F.sum(peso).alias("w")))
    entre = e
    for x in ("src", "dst"):
        lado = (grupos.select(F.col("id").alias(x), F.col("comunidad").alias(f"c_{x}"))
                .join(e.groupBy(x).agg(F.count("*").alias("n")), x))
        entre = unir_por_clave(entre, lado, x, filas)
    entre, _ = corte.guardar(entre.groupBy("c_src", "c_dst").agg(F.sum("w").alias("w")))
    mismo = F.col("c_src") == F.col("c_dst")
    por_lado = (entre.select(F.inline(F.array(
        F.struct(F.col("c_src").alias("comunidad"), F.when(mismo, F.col("w")).alias("d"),
                 F.when(~mismo, F.col("w")).alias("f")),
        F.struct(F.col("c_dst").alias("comunidad"), F.lit(None).cast("bigint").alias("d"),
                 F.when(~mismo, F.col("w")).alias("f")))))
        .groupBy("comunidad").agg(F.sum("d").alias("d"), F.sum("f").alias("f")))
    m = entre.agg(F.sum("w")).scalar().cast("double")
    d, f = F.coalesce("d", F.lit(0)).cast("bigint"), F.coalesce("f", F.lit(0)).cast("bigint")
    parte = (2 * d + f) / (2 * m)
    return (grupos.groupBy("comunidad").agg(F.count("*").alias("miembros")).join(por_lado, "comunidad", "left")
            .select("comunidad", "miembros", d.alias("peso_dentro"), f.alias("peso_fuera"),
                    F.coalesce(F.round(d / m - parte * parte, 9), F.lit(0.0)).alias("modularidad")))
