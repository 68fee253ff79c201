"""Exact top-k by inner product with Fagin's threshold algorithm.

Candidates lie in blocks; a block has one sorted list a dimension.  A query walks down the lists from the end that its
sign makes the best one, scores every row that it meets for the first time in full, and stops when its kth best score
beats the bound: the score of a row that had in each list the value reached there.  The kth score is carried on from
block to block, so later blocks stop earlier, many before their first row.

Equal vectors are one candidate with the ``k + 1`` smallest ids and one query: copies are never scored twice, however
many there are, and no more ids of one vector can be among the best.  Groups of queries meet groups of candidates:
each pair of groups is one key, so that a task holds a bounded group of queries and reads its candidates block by block.
No row is left out by that: all queries meet all candidates.

Integer vectors of different lengths are filled up with zeros.  A row of the same id as the query is the query's own.
Equal rows (id and vector) count once; rows without an id are candidates after all others of the same score, and no
queries.  Scores are exact; beyond the range of a long they are its nearest end.  Without queries or candidates the
result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, LongType, StructField, StructType

from comanda.llm.comun import unir_repartido
from comanda.plans.durable import Corte

#: Numbers in the vectors of a block, of the queries that a task holds, and of the candidates that a task reads.
BLOQUE, CONSULTAS, CANDIDATOS = 1 << 19, 1 << 22, 1 << 24
#: Places of the lists that are read first; each further step reads twice as many.
PRIMER_TRAMO = 16
SIN_ID = (1 << 63) - 1
_PAR = StructType([StructField("consulta", LongType()), StructField("ids", ArrayType(LongType())),
                   StructField("puntos", DecimalType(38, 0))])
#: Scores are compared exactly up to 38 digits.
MAX_PUNTOS = 10**38 - 1


def _exacto(*m: np.ndarray) -> type:
    """Number type in which inner products of these vectors are exact: doubles, longs or Python's integers."""
    tope = max(1, m[0].shape[-1])
    for x in m:
        tope *= max(1, abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    return np.float64 if tope < 1 << 52 else np.int64 if tope < 1 << 62 else object


class Listas:
    """A block of candidates, rows of integers in the order that ties follow, with a sorted list a dimension."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.orden = np.argsort(x, axis=0, kind="stable").T.copy()
        self.valor = np.sort(x, axis=0).T.copy()
        self.vista = {np.int64: (self.x, self.valor)}

    def como(self, tipo: type) -> tuple[np.ndarray, np.ndarray]:
        if tipo not in self.vista:
            self.vista[tipo] = self.x.astype(tipo), self.valor.astype(tipo)
        return self.vista[tipo]

    def mejores(self, q: np.ndarray, k: int, piso: int | None, tipo: type) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows and scores, best first, among which are all of the k best that reach ``piso`` (a score that k other
        candidates are known to reach), and the number of rows scored."""
        n = len(self.x)
        x, valor = self.como(tipo)
        suben, bajan = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        w = q.astype(tipo)
        wm, wn = w[suben], w[bajan]
        filas, puntos = np.zeros(0, np.int64), np.zeros(0, tipo)
        visto, a, tramo, leidas = np.zeros(n, bool), 0, PRIMER_TRAMO, 0
        while a < n:
            # no row still unseen has more in any dimension than the place reached in its list
            cota = wm @ valor[suben, n - 1 - a] + wn @ valor[bajan, a]
            if piso is not None and cota < piso:
                break
            b = min(n, a + tramo)
            nuevo = np.zeros(n, bool)
            nuevo[self.orden[suben, n - b:n - a]] = True
            nuevo[self.orden[bajan, a:b]] = True
            if not len(suben) and not len(bajan):
                nuevo[:] = True
            nuevo &= ~visto
            i = np.flatnonzero(nuevo)
            if len(i):
                visto |= nuevo
                leidas += len(i)
                filas, puntos = np.append(filas, i), np.append(puntos, x[i] @ w)
                if len(filas) > k:
                    mejor = np.lexsort((filas, -puntos))[:k]
                    filas, puntos = filas[mejor], puntos[mejor]
                if len(filas) == k:
                    # rows of the same score may come first by id: stop only below it
                    kesima = puntos.min()
                    piso = kesima if piso is None else max(piso, kesima)
                if leidas == n:
                    break
            a, tramo = b, 2 * tramo
        return filas, puntos, leidas


class _Grupo:
    """The queries of a task and their best candidates so far: (score, smallest id, ids)."""

    def __init__(self, claves: np.ndarray, q: np.ndarray, k: int):
        self.claves, self.q, self.k = claves, q, k
        self.hallados: list[list] = [[] for _ in claves]

    def bloque(self, x: np.ndarray, ids: list) -> None:
        primero = np.array([i[0] if i[0] is not None else SIN_ID for i in ids])
        orden = np.argsort(primero, kind="stable")
        listas, d = Listas(x[orden]), x.shape[1]
        tipo = _exacto(x, self.q)
        for j in range(len(self.claves)):
            q, mios = self.q[j], self.hallados[j]
            piso = mios[-1][0] if len(mios) == self.k else None
            if q[d:].any():  # the block's rows are shorter than the query
                q = q[:d]
            filas, puntos, _ = listas.mejores(q[:d], self.k, piso, tipo)
            mios += [(int(p), int(primero[orden[f]]), ids[orden[f]]) for f, p in zip(filas.tolist(), puntos.tolist())]
            mios.sort(key=lambda m: (-m[0], m[1]))
            del mios[self.k:]

    def salida(self) -> Iterator[pa.RecordBatch]:
        for j in range(0, len(self.claves), 1000):
            filas = [(c, m[2], max(-MAX_PUNTOS, min(MAX_PUNTOS, m[0]))) for c, mios in
                     zip(self.claves[j:j + 1000].tolist(), self.hallados[j:j + 1000]) for m in mios]
            if filas:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[0] for f in filas], pa.int64()), pa.array([f[1] for f in filas], pa.list_(pa.int64())),
                     pa.array([f[2] for f in filas], pa.decimal128(38, 0))], ["consulta", "ids", "puntos"])


def _matriz(a: pa.Array, d: int) -> np.ndarray:
    largo = np.diff(a.offsets.to_numpy())
    plano = a.flatten().to_numpy(zero_copy_only=False)
    x = np.zeros((len(a), d), np.int64)
    x[np.repeat(np.arange(len(a)), largo), np.arange(len(plano)) - np.repeat(np.cumsum(largo) - largo, largo)] = plano
    return x


def _recorrer(k: int, d: int):
    """``mapInArrow`` over rows (g, h, lado, clave, ids, v) sorted by pair of groups: its queries first."""
    por_bloque = max(1, BLOQUE // max(1, d))

    def paso(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        par, grupo, cola = None, None, []

        def cerrar_consultas() -> _Grupo:
            claves = np.concatenate([c for c, _ in cola])
            return _Grupo(claves, np.concatenate([m for _, m in cola]), k)

        for lote in lotes:
            g, h, lado = (lote.column(i).to_numpy() for i in range(3))
            corte = np.flatnonzero((g[1:] != g[:-1]) | (h[1:] != h[:-1]) | (lado[1:] != lado[:-1])) + 1
            for i, j in zip([0, *corte.tolist()], [*corte.tolist(), lote.num_rows]):
                if i == j:
                    continue
                if (g[i], h[i]) != par:
                    if grupo:
                        yield from grupo.salida()
                    par, grupo, cola = (g[i], h[i]), None, []
                for a in range(i, j, por_bloque):
                    parte = lote.slice(a, min(por_bloque, j - a))
                    x = _matriz(parte.column(5), d)
                    if lado[i] == 0:
                        cola.append((parte.column(3).to_numpy(), x))
                        continue
                    if cola:
                        grupo, cola = cerrar_consultas(), []
                    if grupo:
                        grupo.bloque(x, parte.column(4).to_pylist())
        if grupo:
            yield from grupo.salida()

    return paso


def mejores(vectores: DataFrame, es_consulta: Column, k: int, id_: str = "id", vector: str = "v") -> DataFrame:
    """(consulta, puesto, candidato, puntos): of each query the ``k`` rows with the highest inner product, ties to the
    smaller id.  ``vector`` holds integers without nulls, ``es_consulta`` is a condition on the row; see above."""
    spark = vectores.sparkSession
    corte = Corte(spark, "mejores")
    base, n = corte.guardar(vectores.select(F.col(id_).cast("bigint").alias("id"), F.col(vector).alias("v"),
                                            F.coalesce(es_consulta & F.col(id_).isNotNull(), F.lit(False)).alias("q"))
                            .groupBy("id", "v").agg(F.max("q").alias("q")))
    # Spark drops rows beyond the k + 1 before they are dealt out by vector
    orden = W.partitionBy("v").orderBy(F.col("id").asc_nulls_last())
    primeros = (base.withColumn("r", F.row_number().over(orden)).filter(F.col("r") <= k + 1)
                .groupBy("v").agg(F.sort_array(F.collect_list(F.struct(F.col("id").isNull().alias("sin"), "id")))
                                  .alias("ids"))
                .select(F.monotonically_increasing_id().alias("clave"), F.col("ids.id").alias("ids"), "v"))
    candidatos, nc = corte.guardar(primeros)
    preguntan = base.filter("q").select("id", "v")
    consultas, nq = corte.guardar(preguntan.groupBy("v").agg(F.count("*").alias("n"))
                                  .select(F.monotonically_increasing_id().alias("clave"), "v", "n"))
    d = candidatos.agg(F.max(F.size("v"))).first()[0] or 0
    ancho = max(1, d)
    gq = max(1, -(-nq * ancho // CONSULTAS))
    # at least two tasks a core
    gc = max(1, -(-nc * ancho // CANDIDATOS), min(-(-nc // 64), -(-2 * spark.sparkContext.defaultParallelism // gq)))
    grupo_de = lambda c, m: F.pmod(F.xxhash64(c), F.lit(m)).cast("int")
    todos = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    nada = F.lit(None).cast("array<bigint>")
    filas = (consultas.select(grupo_de("clave", gq).alias("g"), todos(gc).alias("h"), F.lit(0).alias("lado"), "clave",
                              nada.alias("ids"), "v")
             .unionByName(candidatos.select(todos(gq).alias("g"), grupo_de("clave", gc).alias("h"),
                                            F.lit(1).alias("lado"), "clave", "ids", "v")))
    tipo = _PAR
    pares = (filas.repartition(gq * gc, "g", "h").sortWithinPartitions("g", "h", "lado", "clave")
             .mapInArrow(_recorrer(k + 1, d), tipo))
    # of each distinct query vector the k + 1 best rows: one of them may be the query's own
    por_puntos = [F.desc("puntos"), F.col("candidato").asc_nulls_last()]
    hallados = (pares.select(F.col("consulta").alias("clave"), "puntos", F.explode("ids").alias("candidato"))
                .withColumn("r", F.row_number().over(W.partitionBy("clave").orderBy(*por_puntos)))
                .filter(F.col("r") <= k + 1)
                .groupBy("clave").agg(F.sort_array(F.collect_list(F.struct("r", "candidato", "puntos"))).alias("l")))
    resultado = consultas.join(hallados, "clave").select("v", "n", "l")
    resultado, _ = corte.guardar(resultado)
    propios = unir_repartido(preguntan, resultado, "v", "n", max(1, n))
    ajenos = F.filter("l", lambda x: ~F.equal_null(x["candidato"], F.col("id")))
    return (propios.select(F.col("id").alias("consulta"), F.posexplode(F.slice(ajenos, 1, k)).alias("p", "m"))
            .select("consulta", (F.col("p") + 1).alias("puesto"), F.col("m.candidato").alias("candidato"),
                    F.greatest(F.lit(-SIN_ID - 1), F.least(F.lit(SIN_ID), "m.puntos")).cast("bigint").alias("puntos")))
