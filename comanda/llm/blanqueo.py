"""Whitening of embeddings by QDWH spectral divide and conquer.

Sums, covariance and the check of the result are aggregates over all rows; only matrices of dimension x dimension
numbers reach the driver.  There the covariance is split: the orthogonal polar factor of ``V - shift I``, found by the
dynamically weighted Halley iteration (Nakatsukasa & Higham, SISC 2013), gives the projector on the eigenvectors above
the shift; the matrix is reduced to that subspace and to its complement, and both are split again.

A vector that is null, or has a null or non-finite entry, takes no part.  Vectors of different lengths are filled up with
zeros.  Null ids and repeated rows are rows like others.  A component without variance (fewer rows than components, equal
vectors) is null in ``blanqueado``; so is ``explicado`` where nothing varies, and ``desvio`` where it leaves the range of
a long.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DecimalType, DoubleType, IntegerType, LongType, StructField, StructType)

from comanda.llm.comun import como_fila

EPS = np.finfo(float).eps
#: Rows of a step: a step holds a few matrices of this many rows.
FILAS_POR_PASO = 4_096
#: The covariance is dimension x dimension numbers on the driver; 4,096 of them are 128 MB.
MAX_DIMENSIONES = 4_096


def sirve(v: Column) -> Column:
    """Neither null nor holding a null or non-finite entry."""
    d = v.cast("array<double>")
    finito = F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(finito, F.lit(False))


def enteros(v: Column, escala: int, suma: int) -> Column:
    """floor(escala * c) + suma of each entry; an entry beyond the range of a long becomes its nearest end."""
    tope = float(1 << 62)
    return F.transform(v.cast("array<double>"), lambda c: F.floor(
        F.greatest(F.lit(-tope), F.least(F.lit(tope), c * F.lit(float(escala))))).cast("bigint") + F.lit(suma))


def matriz(a: pa.Array, d: int, relleno: int = 0) -> np.ndarray:
    """Integer vectors of a batch as rows of ``d`` numbers."""
    n = len(a)
    largo = np.diff(a.offsets.to_numpy()) if n else np.zeros(0, np.int64)
    plano = a.flatten().to_numpy(zero_copy_only=False)
    if n and (largo == d).all():
        return plano.reshape(n, d)
    x = np.full((n, d), relleno, np.int64)
    x[np.repeat(np.arange(n), largo), np.arange(len(plano)) - np.repeat(np.cumsum(largo) - largo, largo)] = plano
    return x


def _pasos(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lote in lotes:
        for i in range(0, lote.num_rows, FILAS_POR_PASO):
            yield lote.slice(i, FILAS_POR_PASO)


# ---- aggregates ----------------------------------------------------------------------------------------------------

def _sumas(x: DataFrame, d: int, relleno: int) -> tuple[int, list[int]]:
    """Number of rows and exact sum of each dimension."""
    tipo = StructType([StructField("i", IntegerType()), StructField("s", DecimalType(38, 0))])

    def parcial(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * d, 0
        for lote in _pasos(lotes):
            m = matriz(lote.column(0), d, relleno)
            n += len(m)
            # halves of 32 bits: neither sum can leave 64 bits, however many rows a step has
            alto, bajo = (m >> 32).sum(0), (m & 0xFFFFFFFF).sum(0)
            total = [t + (int(a) << 32) + int(b) for t, a, b in zip(total, alto, bajo)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([*range(d), d], pa.int32()), pa.array([*total, n], pa.decimal128(38, 0))], ["i", "s"])

    suma = {r["i"]: int(r["s"]) for r in x.mapInArrow(parcial, tipo).groupBy("i").agg(F.sum("s").cast("decimal(38,0)")
                                                                                      .alias("s")).collect()}
    return suma.get(d, 0), [suma.get(i, 0) for i in range(d)]


def _gram(df: DataFrame, d: int, filas) -> np.ndarray:
    """Sum of the outer products of the rows that ``filas(batch)`` makes, ``d`` numbers each.  A task adds up its own
    rows; what is shuffled and collected is d x d numbers."""
    tipo = StructType([StructField("i", IntegerType()), StructField("g", ArrayType(DoubleType()))])

    def parcial(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, hay = np.zeros((d, d)), False
        for lote in _pasos(lotes):
            m = filas(lote)
            g, hay = g + m.T @ m, True
        if hay:
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(list(g))], ["i", "g"])

    celdas = (df.mapInArrow(parcial, tipo).select("i", F.posexplode("g").alias("j", "v"))
              .groupBy("i", "j").agg(F.sum("v").alias("v")))
    g = np.zeros((d, d))
    for r in celdas.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", "v"))).alias("f")).collect():
        g[r["i"]] = [c["v"] for c in r["f"]]
    return (g + g.T) / 2


# ---- spectral divide and conquer -------------------------------------------------------------------------------------

def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QR-based dynamically weighted Halley iteration."""
    n = len(a)
    x, menor, uno = a / np.linalg.norm(a), EPS / n, np.eye(n)
    for _ in range(12):
        l2 = menor * menor
        raiz = (4 * (1 - l2) / (l2 * l2)) ** (1 / 3)
        p = np.sqrt(1 + raiz) + 0.5 * np.sqrt(max(0.0, 8 - 4 * raiz + 8 * (2 - l2) / (l2 * np.sqrt(1 + raiz))))
        q = (p - 1) ** 2 / 4
        c = p + q - 1
        m, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, uno]))
        sigue = q / c * x + (p - q / c) / np.sqrt(c) * (m[:n] @ m[n:].T)
        sigue = (sigue + sigue.T) / 2
        salto = np.linalg.norm(sigue - x)
        x, menor = sigue, min(1.0, menor * (p + q * l2) / (1 + c * l2))
        if salto < (10 * EPS) ** (1 / 3) and 1 - menor < 10 * EPS:
            break
    return x


def _partir(a: np.ndarray, escala: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the eigenvectors above and below a shift, or None where no shift splits the matrix.

    The mean eigenvalue lies strictly between the smallest and the largest one.  Where an eigenvalue meets the shift,
    the polar factor is not orthogonal; another shift is taken then.
    """
    n = len(a)
    media = np.trace(a) / n
    ancho = np.linalg.norm(a - media * np.eye(n)) / np.sqrt(n)
    mejor, resto = None, np.inf
    for paso in (0.0, 0.17, -0.23, 0.41, -0.37, 0.03, -0.07):
        u = polar(a - (media + paso * ancho) * np.eye(n))
        k = round((np.trace(u) + n) / 2)
        if not 0 < k < n:
            continue
        proyector = (u + np.eye(n)) / 2
        # subspace iteration from a fixed start: the first k columns span the projector's range, the others its kernel
        base = np.linalg.qr(np.random.default_rng(n).standard_normal((n, k)))[0]
        for _ in range(2):
            base = np.linalg.qr(proyector @ base, mode="complete")[0]
            arriba, abajo = base[:, :k], base[:, k:]
            base = arriba
        error = np.linalg.norm(abajo.T @ a @ arriba)
        if error < resto:
            mejor, resto = (arriba, abajo), error
        if resto <= 10 * n * EPS * escala:
            break
    return mejor if resto <= 1e-9 * escala else None


def espectro(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, of a symmetric matrix."""
    escala = np.linalg.norm(v)
    hojas: list[tuple[float, np.ndarray]] = []
    pila = [(v, np.eye(len(v)))] if len(v) else []
    while pila:
        a, base = pila.pop()
        n = len(a)
        iguales = np.linalg.norm(a - np.trace(a) / n * np.eye(n)) <= n * EPS * escala
        partes = None if n == 1 or iguales else _partir(a, escala)
        if partes is None:  # one eigenvalue, to rounding: every basis is one of eigenvectors
            hojas += [(a[i, i], base[:, i]) for i in range(n)]
            continue
        for q in partes:
            b = q.T @ a @ q
            pila.append(((b + b.T) / 2, base @ q))
    hojas.sort(key=lambda h: -h[0])
    d = len(v)
    return np.array([h[0] for h in hojas]), np.array([h[1] for h in hojas]).reshape(d, d).T


# ---- model and use ---------------------------------------------------------------------------------------------------

@dataclass
class Modelo:
    """Fit of ``n`` integer vectors: exact sums, eigenvalues and unit eigenvectors of the first components."""

    n: int
    sumas: list[int]
    relleno: int
    valores: np.ndarray = field(default_factory=lambda: np.zeros(0))
    vectores: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    traza: float = 0.0

    @property
    def media(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sumas])

    @property
    def explicado(self) -> list[float | None]:
        return [float(e / self.traza) if self.traza > 0 else None for e in self.valores]

    @property
    def con_varianza(self) -> np.ndarray:
        """Components that rounding alone does not explain."""
        d = len(self.sumas)
        return self.valores > (d * EPS * self.valores[0] if len(self.valores) else 0)

    @property
    def lienzo(self) -> np.ndarray:
        """What a centred row is multiplied with; columns of zeros for components without variance."""
        ok = self.con_varianza
        return self.vectores * np.where(ok, 1 / np.sqrt(np.where(ok, self.valores, 1)), 0.0)


def ajustar(vectores: DataFrame, componentes: int, relleno: int = 0, columna: str = "x") -> Modelo:
    """Fits ``componentes`` components to the integer vectors of a table without nulls; three scans of it."""
    x = vectores.select(columna)
    d = x.agg(F.max(F.size(columna))).first()[0] or 0
    if d > MAX_DIMENSIONES:
        raise ValueError(f"vectors of {d} dimensions: the covariance is held by the driver up to {MAX_DIMENSIONES}")
    n, sumas = _sumas(x, d, relleno) if d else (x.count(), [])
    m = Modelo(n, sumas, relleno)
    if not n or not d:
        return m
    media = m.media
    v = _gram(x, d, lambda lote: matriz(lote.column(0), d, relleno) - media) / n
    valores, ejes = espectro(v)
    k = min(componentes, d)
    m.valores, m.vectores, m.traza = np.maximum(valores[:k], 0), ejes[:, :k], float(np.trace(v))
    return m


def desvios(x: np.ndarray, n: int, sumas: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2, exact; None beyond the range of a long."""
    if not x.size:
        return [0] * len(x)
    tope = n * max(abs(int(x.max())), abs(int(x.min()))) + max(abs(s) for s in sumas)
    if tope < 1 << 62:
        y = n * x - np.array(sumas, np.int64)
        lejos = int(np.abs(y).max())
        if lejos * lejos * x.shape[1] < 1 << 63:
            return (y * y).sum(1).tolist()
        y = y.astype(object)
    else:
        y = n * x.astype(object) - np.array(sumas, object)
    return [t if t < 1 << 63 else None for t in (y * y).sum(1)]


def blanquear(filas: DataFrame, m: Modelo, vector: str = "x") -> DataFrame:
    """``fila``, ``desvio`` (see ``desvios``) and ``blanqueado``, one number a component, of a table whose column
    ``vector`` has integer vectors without nulls.  The model is broadcast: dimension x components numbers."""
    campo, k = filas.columns.index(vector), len(m.valores)
    n, sumas, d, relleno = m.n, m.sumas, len(m.sumas), m.relleno
    tipo = StructType([StructField("fila", filas.schema, False), StructField("desvio", LongType()),
                       StructField("blanqueado", ArrayType(DoubleType()))])
    difundido = filas.sparkSession.sparkContext.broadcast((m.media, m.lienzo, m.con_varianza) if n else None)

    def paso(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lote in _pasos(lotes):
            media, lienzo, ok = difundido.value
            x = matriz(lote.column(0).field(campo), d, relleno)
            y = (x - media) @ lienzo if d else np.zeros((len(x), 0))
            plano = pa.array(y.ravel(), mask=np.tile(~ok, len(x)) if d else None)
            listas = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), plano)
            yield pa.RecordBatch.from_arrays(
                [lote.column(0), pa.array(desvios(x, n, sumas), pa.int64()), listas], ["fila", "desvio", "blanqueado"])

    return como_fila(filas).mapInArrow(paso, tipo)


def error_identidad(blanqueados: DataFrame, m: Modelo) -> float | None:
    """Largest entry of the covariance of the whitened rows minus the identity, over components with variance; the
    mean is taken from the rows themselves."""
    ok = m.con_varianza
    k = int(ok.sum())
    if not k:
        return None

    def filas(lote: pa.RecordBatch) -> np.ndarray:
        y = lote.column(0).flatten().to_numpy(zero_copy_only=False).reshape(lote.num_rows, len(ok))[:, ok]
        return np.hstack([y, np.ones((len(y), 1))])

    g = _gram(blanqueados.select("blanqueado"), k + 1, filas)
    n, suma = g[k, k], g[k, :k]
    # the rows are centred to rounding, so the square of their mean is lost in the rounding of the products
    return float(np.abs(g[:k, :k] / n - np.outer(suma / n, suma / n) - np.eye(k)).max())
