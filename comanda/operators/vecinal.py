"""Paths of fewest metres on a network that fits one task: each origin is searched where its pairs lie.

A task reads the network from the shared folder, searches some origins at a time by array operations and writes the paths
of their pairs batch by batch.  No label is a row, and no path is stored or shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

#: Rows of a network (both directions) that one task holds: about 300 MB of its memory.
TRAMOS_EN_TAREA = 4_000_000
#: Labels (origin, node) of one search, and node ids of one batch of paths.
ETIQUETAS_POR_BUSQUEDA = 4_000_000
NODOS_POR_LOTE = 1_000_000
#: Pairs of one task; an origin with more is searched in several.
PARES_POR_TAREA = 20_000


class Red:
    """A network as arrays: nodes are places in ``ids``, the segments of node v are those from ``ini[v]`` to ``ini[v + 1]``."""

    def __init__(self, src: np.ndarray, dst: np.ndarray, metros: np.ndarray):
        orden = np.lexsort((dst, src))
        self.ids, self.u = np.unique(src[orden], return_inverse=True)
        self.v = np.searchsorted(self.ids, dst[orden])
        self.w = metros[orden]
        self.ini = np.searchsorted(self.u, np.arange(len(self.ids) + 1))
        self.ancho = float(np.median(self.w)) if len(self.w) else 0.0

    def lugar(self, nodos: np.ndarray) -> np.ndarray:
        """Places of node ids, -1 for those without a segment."""
        i = np.minimum(np.searchsorted(self.ids, nodos), max(0, len(self.ids) - 1))
        return np.where(self.ids[i] == nodos, i, -1) if len(self.ids) else np.full(len(nodos), -1)

    def buscar(self, origenes: np.ndarray, metas: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Metres and segments (fewest metres, then segments) from each origin, a row of both, until the labels ``metas``
        (row * nodes + place) are final.  A label is taken up again whenever it gets better, so the order, by stretches of
        the median segment, is a matter of time only."""
        n = len(self.ids)
        d, h = np.full(len(origenes) * n, np.inf), np.zeros(len(origenes) * n, np.int32)
        espera = np.zeros(len(d), bool)
        cola = np.arange(len(origenes)) * n + origenes
        d[cola], espera[cola], vuelta = 0.0, True, 0
        while len(cola):
            dc = d[cola]
            primero = dc.min()
            if vuelta % 16 == 0 and primero > d[metas].max():
                break
            vuelta += 1
            ahora = dc <= primero + self.ancho
            x, cola = cola[ahora], cola[~ahora]
            espera[x] = False
            v = x % n
            cuantos = self.ini[v + 1] - self.ini[v]
            hasta = np.cumsum(cuantos)
            tramo = np.arange(hasta[-1]) + np.repeat(self.ini[v] - hasta + cuantos, cuantos)
            y = np.repeat(x - v, cuantos) + self.v[tramo]
            dy, hy = np.repeat(d[x], cuantos) + self.w[tramo], np.repeat(h[x], cuantos) + 1
            mejor = (dy < d[y]) | ((dy == d[y]) & (hy < h[y]))
            y, dy, hy = y[mejor], dy[mejor], hy[mejor]
            orden = np.lexsort((hy, dy, y))
            y = y[orden]
            uno = np.flatnonzero(np.concatenate([[True], y[1:] != y[:-1]])[:len(y)])
            y, orden = y[uno], orden[uno]
            d[y], h[y] = dy[orden], hy[orden]
            cola = np.concatenate([cola, y[~espera[y]]])
            espera[y] = True
        return d.reshape(-1, n), h.reshape(-1, n)

    def previos(self, d: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The node before each one on the way from an origin; of equally good ones the smallest."""
        de = np.flatnonzero((d[self.u] + self.w == d[self.v]) & (h[self.u] + 1 == h[self.v]))[::-1]
        previo = np.full(len(self.ids), -1)
        previo[self.v[de]] = self.u[de]
        return previo


def _caminos(previo: np.ndarray, fin: np.ndarray, nodos: np.ndarray) -> np.ndarray:
    """The paths to ``fin``, of falling numbers of ``nodos``, one behind the other."""
    hasta, todos = np.cumsum(nodos), np.empty(int(nodos.sum()), np.int64)
    for s, k in enumerate(np.searchsorted(-nodos, -np.arange(nodos[0]))):
        fin = fin[:k]
        todos[hasta[:k] - 1 - s] = fin
        fin = previo[fin]
    return todos


def _lote(pares: pa.Table, filas: np.ndarray, saltos: np.ndarray, metros: np.ndarray, calles: np.ndarray) -> list[pa.RecordBatch]:
    hasta = np.concatenate([[0], np.cumsum(saltos + 1)]).astype(np.int32)
    t = pares.take(pa.array(filas)).append_column("saltos", pa.array(saltos.astype(np.int32)))
    t = t.append_column("distancia", pa.array(metros)).append_column("calles", pa.ListArray.from_arrays(pa.array(hasta), pa.array(calles)))
    return t.combine_chunks().to_batches()


def _responder(red: Red, pares: pa.Table) -> Iterator[pa.RecordBatch]:
    origen, destino = (pares[c].to_numpy() for c in ("origen", "destino"))
    o, t = red.lugar(origen), red.lugar(destino)
    # a node without segments has a path to itself only
    suyas = np.flatnonzero((o < 0) & (origen == destino))
    if len(suyas):
        yield from _lote(pares, suyas, np.zeros(len(suyas), np.int64), np.zeros(len(suyas)), origen[suyas])
    filas = np.flatnonzero((o >= 0) & (t >= 0))
    if not len(filas):
        return
    n, todos = len(red.ids), np.unique(o[filas])
    juntos = max(1, ETIQUETAS_POR_BUSQUEDA // n)
    for i in range(0, len(todos), juntos):
        grupo = todos[i:i + juntos]
        de = filas[(o[filas] >= grupo[0]) & (o[filas] <= grupo[-1])]
        d, h = red.buscar(grupo, np.searchsorted(grupo, o[de]) * n + t[de])
        for k, x in enumerate(grupo):
            suyas = de[o[de] == x]
            suyas = suyas[np.isfinite(d[k][t[suyas]])]
            if not len(suyas):
                continue
            previo = red.previos(d[k], h[k])
            suyas = suyas[np.argsort(-h[k][t[suyas]], kind="stable")]
            nodos = h[k][t[suyas]].astype(np.int64) + 1
            lote = (np.cumsum(nodos) - 1) // NODOS_POR_LOTE
            for f in np.split(np.arange(len(suyas)), np.flatnonzero(lote[1:] != lote[:-1]) + 1):
                y = t[suyas[f]]
                yield from _lote(pares, suyas[f], nodos[f] - 1, d[k][y], red.ids[_caminos(previo, y, nodos[f])])


def _tarea(archivos: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def ir(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        red, juntos, n = None, [], 0

        def tanda() -> Iterator[pa.RecordBatch]:
            nonlocal red
            if red is None:
                sistema, _ = fs.FileSystem.from_uri(archivos[0])
                t = pa.concat_tables([pq.read_table(fs.FileSystem.from_uri(x)[1], filesystem=sistema, columns=["src", "dst", "distancia"])
                                      for x in archivos])
                red = Red(*(t[c].to_numpy() for c in t.column_names))
            yield from _responder(red, pa.Table.from_batches(juntos))

        for lote in lotes:
            juntos, n = [*juntos, lote], n + lote.num_rows
            if n >= 2 * PARES_POR_TAREA:
                yield from tanda()
                juntos, n = [], 0
        if n:
            yield from tanda()

    return ir


def cabe(pares: DataFrame, red: DataFrame, filas: int) -> bool:
    """Whether a task can hold the written network ``red(src, dst, distancia)`` of so many rows: whole-number ids, lengths
    of at least nothing, and files that ``pyarrow.fs`` opens."""
    enteros = all(isinstance(df.schema[c].dataType, LongType) for df, cs in ((pares, ("origen", "destino")), (red, ("src", "dst"))) for c in cs)
    if not enteros or filas > TRAMOS_EN_TAREA:
        return False
    # not-a-number is above everything, a missing length is counted
    menos, mas, sin = red.agg(F.min("distancia"), F.max("distancia"), F.count_if(F.col("distancia").isNull())).first()
    try:
        return not sin and (menos is None or (menos >= 0 and mas < float("inf"))) and all(
            fs.FileSystem.from_uri(x) for x in red.inputFiles()[:1])
    except (pa.ArrowException, OSError):
        return False


def caminos_mas_cortos(pares: DataFrame, red: DataFrame, filas_pares: int) -> DataFrame:
    """``pares(origen, destino, ...)`` that a path joins, with saltos, distancia and ``calles`` of the path of fewest
    metres, then segments; ties go to the smallest node before.  ``red`` is a written network that ``cabe``."""
    pares = pares.filter("origen IS NOT NULL AND destino IS NOT NULL")
    partes = max(pares.sparkSession.sparkContext.defaultParallelism, -(-filas_pares // PARES_POR_TAREA))
    llenos = (pares.groupBy("origen").agg(F.count("*").alias("_n")).filter(F.col("_n") > PARES_POR_TAREA)
              .select("origen", F.ceil(F.col("_n") / PARES_POR_TAREA).alias("_partes")))
    sal = F.pmod(F.xxhash64("destino"), F.coalesce("_partes", F.lit(1).cast("bigint")))
    # one origin's pairs lie together
    dados = (pares.join(F.broadcast(llenos), "origen", "left").withColumn("_sal", sal).repartition(partes, "origen", "_sal")
             .sortWithinPartitions("origen").select(*pares.columns))
    esquema = ", ".join([*(f"`{c.name}` {c.dataType.simpleString()}" for c in pares.schema), "saltos int, distancia double, calles array<bigint>"])
    return dados.mapInArrow(_tarea(list(red.inputFiles())), esquema)
