"""Helpers shared by the text operators: whole rows through Arrow, words as byte spans, bounded batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAYUSCULAS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MINUSCULAS = MAYUSCULAS.lower()

# the two word patterns are sets of bytes: every byte of a character beyond ASCII is a word byte in both
PALABRA = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NO_BLANCO = r"[^\x20\x09-\x0D]+"
_BYTES = np.arange(256)
ES_PALABRA = (_BYTES >= 0x80) | ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
ES_NO_BLANCO = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
_A_MINUSCULA = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

#: Bytes of text that one step works on; a longer text is a step of its own.
BYTES_POR_PASO = 4 << 20
#: Bytes of text whose letters are numbers at one time: a letter takes some fifty bytes while words are hashed.
BYTES_POR_TRAMO = 1 << 18

_azar = np.random.default_rng(20_231)
_MEZCLA = _azar.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_POTENCIA = _azar.integers(1, 2**63, 4096, dtype=np.uint64) | np.uint64(1)


def leer(spark: SparkSession, sf_dir: str, tabla: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{tabla}.parquet")


def minusculas(c: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(c, MAYUSCULAS, MINUSCULAS)


def como_fila(df: DataFrame) -> DataFrame:
    """The whole row as one struct, so no column of the input can clash with one that an operator adds."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("fila"))


def textos(lote: pa.RecordBatch, campo: int) -> pa.Array:
    """The text column of a batch of ``como_fila``; a null text is empty."""
    t = lote.column(0).field(campo)
    return pc.fill_null(t if t.type == pa.string() else t.cast(pa.string()), "")


def por_pasos(f: Callable[[pa.RecordBatch], pa.RecordBatch], campo: int) -> Callable:
    """``mapInArrow`` function that applies ``f`` to slices of at most ``BYTES_POR_PASO`` bytes of text.  ``f`` keeps
    nothing in the worker."""
    def aplicar(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        soltar()
        for lote in lotes:
            yield from map(f, cortar(lote, campo))
    return aplicar


def cortar(lote: pa.RecordBatch, campo: int, paso: int = BYTES_POR_PASO) -> Iterator[pa.RecordBatch]:
    n = lote.num_rows
    if not n:
        return
    fin = np.cumsum(pc.binary_length(textos(lote, campo)).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(fin, (fin[i - 1] if i else 0) + paso, "right")))
        yield lote.slice(i, j - i)
        i = j


class Palabras:
    """Words of a batch of texts as byte spans, found without a Python object per word.

    ``ini`` and ``fin`` are the spans in ``datos``, ``doc`` the text of each word, ``n`` the words of
    each text and ``primera`` the index of its first word.  A-Z count as lower case unless ``igual``.
    """

    def __init__(self, t: pa.Array, clase: np.ndarray, igual: bool = False):
        off = np.frombuffer(t.buffers()[1], np.int32)[t.offset: t.offset + len(t) + 1].astype(np.int64)
        crudo = t.buffers()[2]
        datos = np.frombuffer(crudo, np.uint8)[off[0]: off[-1]] if crudo is not None else np.zeros(0, np.uint8)
        off = off - off[0]
        self.datos = datos if igual else _A_MINUSCULA[datos]
        es = clase[self.datos]
        borde = np.zeros(len(datos) + 1, bool)
        borde[off] = True
        empieza = es.copy()
        empieza[1:] &= ~es[:-1] | borde[1:-1]
        acaba = es.copy()
        acaba[:-1] &= ~es[1:] | borde[1:-1]
        self.es, self.empieza = es, empieza
        self.ini, self.fin = np.flatnonzero(empieza), np.flatnonzero(acaba) + 1
        self.doc = np.searchsorted(off, self.ini, "right") - 1
        self.n = np.bincount(self.doc, minlength=len(t)).astype(np.int64)
        self.primera = np.cumsum(self.n) - self.n

    def _tramos(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """Words in stretches of about ``BYTES_POR_TRAMO`` bytes: the first, the one after the last, where their letters are."""
        a = 0
        while a < len(self.ini):
            b = max(a + 1, int(np.searchsorted(self.fin, self.ini[a] + BYTES_POR_TRAMO, "right")))
            yield a, b, self.ini[a] + np.flatnonzero(self.es[self.ini[a]: self.fin[b - 1]])
            a = b

    def huellas(self) -> np.ndarray:
        """64-bit hash of each word; a first test only, whoever uses it compares bytes afterwards."""
        h = np.zeros(len(self.ini), np.uint64)
        for a, b, letras in self._tramos():
            ini, largo = self.ini[a:b], self.fin[a:b] - self.ini[a:b]
            lugar = letras - ini[np.cumsum(self.empieza[letras]) - 1]
            h[a:b] = np.add.reduceat(_MEZCLA[self.datos[letras]] * _POTENCIA[lugar & 4095], np.cumsum(largo) - largo)
        return h ^ (h >> np.uint64(29))

    def seguidas(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words with one blank between them, and where each one starts and ends."""
        largo = self.fin - self.ini
        fin = np.cumsum(largo + 1) - 1
        ini = fin - largo
        salida = np.full(int(fin[-1]) + 1 if len(fin) else 0, 0x20, np.uint8)
        for a, b, letras in self._tramos():
            salida[letras - np.repeat(self.ini[a:b] - ini[a:b], largo[a:b])] = self.datos[letras]
        return salida.tobytes(), ini, fin


_COEF = _azar.integers(1, 2**63, 8, dtype=np.uint64) | np.uint64(1)


def huellas_de_grupo(h: np.ndarray, g: int) -> np.ndarray:
    """Hash of each run of ``g`` words, from the words' hashes."""
    n = max(0, len(h) - g + 1)
    suma = np.full(n, np.uint64(g), np.uint64)
    for k in range(g):
        suma += (h[k: k + n] ^ (h[k: k + n] >> np.uint64(31))) * _COEF[k]
    return suma ^ (suma >> np.uint64(32))


def unir_repartido(grande: DataFrame, unica: DataFrame, clave: str, peso: str, total: int,
                   partes: int = 1000) -> DataFrame:
    """Joins ``grande`` with one row per key in ``unica``, whose ``peso`` counts the key's rows.

    A key that holds more than 1/``partes`` of the ``total`` rows is joined by broadcast: there are
    fewer than ``partes`` such keys whatever the size.  No other key can fill a task.
    """
    corte = max(1, total // partes)
    calientes = F.broadcast(unica.filter(F.col(peso) > corte))
    frias = unica.filter(F.col(peso) <= corte)
    return (grande.join(calientes, clave)
            .unionByName(grande.join(F.broadcast(calientes.select(clave)), clave, "left_anti").join(frias, clave)))


class Memoria:
    """Remembers values of short texts in two halves: a full half becomes the old one, a hit there is kept.
    ``tope`` bounds the bytes of both halves, counting a Python object's own size for each entry."""

    LARGO = 48
    #: Bytes of an entry besides its characters: text object, value object and dictionary slot.
    COSTE = 220

    def __init__(self, tope: int):
        self.mitad = max(1, tope // 2)
        self.nuevas: dict = {}
        self.viejas: dict = {}
        self.pesan = 0

    def get(self, t: str):
        v = self.nuevas.get(t)
        if v is None and (v := self.viejas.get(t)) is not None:
            self.poner(t, v)
        return v

    def poner(self, t: str, v):
        if len(t) <= self.LARGO:
            if self.pesan >= self.mitad:
                # the dict that callers hold stays the new half
                self.viejas = dict(self.nuevas)
                self.nuevas.clear()
                self.pesan = 0
            self.nuevas[t] = v
            self.pesan += self.COSTE + len(t) + (len(v) if isinstance(v, bytes) else 0)
        return v


_guardado: dict = {}


def soltar() -> None:
    """Frees what an earlier operator keeps in this Python worker, for tasks of operators that keep nothing."""
    if _guardado:
        _guardado.clear()
        gc.collect()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # a C library that cannot: the memory is reused instead
            pass


def por_trabajador(clave: tuple, hacer: Callable):
    """One object per Python worker, kept over tasks with its memory of words.  A worker keeps one only: the object of
    an earlier operator goes, and its memory with it, before another one is made."""
    if clave not in _guardado:
        soltar()
        _guardado[clave] = hacer()
    return _guardado[clave]
