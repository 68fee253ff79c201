"""Byte-level BPE by ranks: overlapping chunks are cut into pre-tokens and encoded in parallel, stitched, decoded.

A pre-token match depends on the text from its start on.  Two cuts of a text that share one boundary
therefore agree from there on, up to where one of them runs out of text: that is where chunks are stitched.  A
chunk is encoded where it is; what meets its neighbours are its ids and the boundaries in the two overlaps.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from comanda.llm.comun import Memoria, como_fila, cortar, por_trabajador
from comanda.plans.durable import Corte

#: Characters of a chunk, and how many of them its successor reads again.
TROZO = 1 << 13
SOLAPE = 1 << 9
#: Chunks of a stretch; a longer text's stretches are dealt out to all tasks, others are cut where they are read.
TROZOS_POR_TRAMO = 128
#: Pre-tokens at the end of a chunk that a longer text could cut otherwise: the last match, and a mark before it
#: that a contraction would have taken.
DUDOSAS = 2
#: Bytes of pre-tokens whose ids a task remembers.
RECUERDA = 64 << 20
NUNCA = 1 << 40
PARTES = ("ids", "cab", "cab_n", "cola", "cola_n")
#: Ids that are decoded at once.
IDS_POR_PASO = 1 << 20


def leer_rangos(ruta: str) -> dict[bytes, int]:
    with open(ruta, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Codificador:
    """Ids of a pre-token by ranks: the adjacent pair of lowest rank merges first, leftmost of equal ones."""

    def __init__(self, ruta: str, patron: str):
        self.rangos = leer_rangos(ruta)
        self.patron = regex.compile(patron)
        self.memo = Memoria(RECUERDA)
        # every pair of tokens that merges, as one number, and the token it makes, whose id is its rank
        r = self.rangos
        pares = sorted((r[t[:k]] << 20 | r[t[k:]], i) for t, i in r.items() for k in range(1, len(t))
                       if t[:k] in r and t[k:] in r)
        self.pares = np.array([p for p, _ in pares] + [1 << 62], np.int64)
        self.une = np.array([i for _, i in pares] + [NUNCA], np.int64)
        self.de_byte = np.array([r.get(bytes([b]), -1) for b in range(256)], np.int64)

    def pieza(self, t: str) -> bytes:
        """Ids of one pre-token as little-endian 32-bit numbers."""
        ids = self.memo.get(t)
        return ids if ids is not None else self.memo.poner(t, np.array(self._unir(t.encode()), "<i4").tobytes())

    def aprender(self, textos: list[list[str]]) -> None:
        """Encodes the short pre-tokens that are not remembered yet, all at once."""
        nuevas = self.memo.nuevas
        faltan = [t for t in set().union(*textos) - nuevas.keys() if self.memo.get(t) is None and len(t) <= Memoria.LARGO]
        en_bytes = sorted(((len(b := t.encode()), b, t) for t in faltan))
        for a in range(0, len(en_bytes), 4096):
            parte = en_bytes[a: a + 4096]
            for (_, _, t), ids in zip(parte, self._unir_muchas([b for _, b, _ in parte])):
                self.memo.poner(t, ids)

    def _rango(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        clave = np.where((a >= 0) & (b >= 0), a << 20 | b, 1 << 61)
        k = np.searchsorted(self.pares, clave)
        return np.where(self.pares[k] == clave, self.une[k], NUNCA)

    def _unir_muchas(self, piezas: list[bytes]) -> list[bytes]:
        """Merges many pre-tokens in step: one row each, every round its best pair, until none has one."""
        largo = np.array([len(b) for b in piezas])
        ids = np.full((len(piezas), int(largo.max()) + 1), -1, np.int64)
        ids[np.arange(ids.shape[1]) < largo[:, None]] = self.de_byte[np.frombuffer(b"".join(piezas), np.uint8)]
        par = self._rango(ids[:, :-1], ids[:, 1:])
        vivas = np.arange(len(piezas))
        v, p = ids, par
        columna = np.arange(ids.shape[1] - 1)
        while len(vivas):
            mejor = p.min(axis=1)
            sigue = mejor < NUNCA
            if not sigue.all():
                ids[vivas[~sigue]] = v[~sigue]
                vivas, v, p, mejor = vivas[sigue], v[sigue], p[sigue], mejor[sigue]
                if not len(vivas):
                    break
            i = p.argmin(axis=1)
            fila = np.arange(len(vivas))
            v[fila, i] = mejor
            # the right part of the pair goes: what follows moves one place left
            corre = columna + (columna > i[:, None])
            v = np.concatenate([np.take_along_axis(v, corre, 1), np.full((len(v), 1), -1)], axis=1)
            ultima = p.shape[1] - 1
            p = np.take_along_axis(p, np.minimum(columna + (columna >= i[:, None]), ultima), 1)
            p[:, ultima] = NUNCA
            p[fila, i] = self._rango(v[fila, i], v[fila, np.minimum(i + 1, ultima + 1)])
            antes = np.maximum(i - 1, 0)
            p[fila, antes] = np.where(i > 0, self._rango(v[fila, antes], v[fila, i]), p[fila, antes])
        n = (ids >= 0).sum(axis=1)
        plano, fin = ids[ids >= 0].astype("<i4").tobytes(), 4 * np.cumsum(n)
        return [plano[z - 4 * k: z] for k, z in zip(n.tolist(), fin.tolist())]

    def _unir(self, b: bytes) -> list[int]:
        r = self.rangos
        if b in r:
            return [r[b]]
        n = len(b)
        # a linked list of parts by their start; stale heap entries name a pair that is no longer there
        sig, ant, fin = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        cola = [(x, i, i + 2) for i in range(n - 1) if (x := r.get(b[i: i + 2])) is not None]
        heapq.heapify(cola)
        while cola:
            _, i, z = heapq.heappop(cola)
            j = sig[i] if fin[i] else n
            if j >= n or fin[j] != z:
                continue
            fin[i], sig[i], fin[j] = z, sig[j], 0
            if sig[i] < n:
                ant[sig[i]] = i
                if (x := r.get(b[i: fin[sig[i]]])) is not None:
                    heapq.heappush(cola, (x, i, fin[sig[i]]))
            if ant[i] >= 0 and (x := r.get(b[ant[i]: z])) is not None:
                heapq.heappush(cola, (x, ant[i], z))
        salida, i = [], 0
        while i < n:
            salida.append(r[b[i: fin[i]]])
            i = sig[i]
        return salida

    def ids(self, piezas: Iterable[str]) -> np.ndarray:
        m = self.memo.nuevas
        return np.frombuffer(b"".join([m.get(p) or self.pieza(p) for p in piezas]), "<i4")

    def trozo(self, piezas: list[str], k: int, fin: bool, paso: int, solape: int) -> dict[str, np.ndarray]:
        """Ids of a chunk and its boundaries in both overlaps, see ``coser``."""
        m = self.memo.nuevas
        de_pieza = [m.get(p) or self.pieza(p) for p in piezas]
        # boundaries: characters and ids before each pre-token
        lugar = np.cumsum([0, *map(len, piezas)], dtype=np.int32)
        n = np.cumsum([0, *[len(b) // 4 for b in de_pieza]], dtype=np.int32)
        fiables = lugar[: max(0, len(piezas) - DUDOSAS) + 1]
        cab = np.flatnonzero(fiables <= solape) if k else np.zeros(0, np.int64)
        cola = np.zeros(0, np.int64) if fin else np.flatnonzero(fiables >= paso)
        return {"ids": np.frombuffer(b"".join(de_pieza), "<i4"), "cab": lugar[cab], "cab_n": n[cab],
                "cola": lugar[cola] - paso, "cola_n": n[cola]}


class Tabla:
    """Bytes of each token by its id."""

    def __init__(self, ruta: str):
        de = {i: b for b, i in leer_rangos(ruta).items()}
        self.bytes_de = pa.array([de.get(i) for i in range(max(de, default=-1) + 1)], pa.binary())

    def textos(self, ids: pa.ListArray) -> pa.Array:
        """Bytes of each list of ids."""
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self.bytes_de.take(ids.values)), pa.scalar(b""))


def codificador(ruta: str, patron: str) -> Codificador:
    """One per Python worker, so its memory of pre-tokens lasts over tasks."""
    return por_trabajador(("bpe", ruta, patron), lambda: Codificador(ruta, patron))


def coser(trozos: list[dict]) -> np.ndarray | None:
    """Ids of a text from its chunks in order, each with ``ids`` and the boundaries that it trusts in the overlap with
    the chunk before (``cab``) and after (``cola``): places counted from where the overlap starts, and ids up to there.

    From a boundary that both have, the later chunk takes over.  None if two neighbours share none, as in a run of
    letters longer than the overlap."""
    partes, desde = [], 0
    for a, b in zip(trozos, trozos[1:]):
        _, i, j = np.intersect1d(a["cola"], b["cab"], assume_unique=True, return_indices=True)
        if not len(i):
            return None
        partes.append(a["ids"][desde: int(a["cola_n"][i[0]])])
        desde = int(b["cab_n"][j[0]])
    return np.concatenate([*partes, trozos[-1]["ids"][desde:]])


def _ultimo(trozo: int, solape: int) -> Column:
    """Number of the last chunk of the text ``t``, from 0."""
    return F.greatest(F.lit(0), F.ceil((F.length("t") - trozo) / (trozo - solape))).cast("bigint")


def _en_trozos(f: DataFrame, trozo: int, solape: int) -> DataFrame:
    """The rows ``f(..., ultimo, j, t)`` with ``t`` cut into the chunks of stretch ``j``: adds ``k``, ``fin``."""
    paso = trozo - solape
    k = F.col("j") * TROZOS_POR_TRAMO + F.col("i")
    resto = [c for c in f.columns if c not in ("ultimo", "j", "t")]
    return (f.withColumn("i", F.explode(F.sequence(F.lit(0), F.least(
                F.lit(TROZOS_POR_TRAMO - 1), F.col("ultimo") - F.col("j") * TROZOS_POR_TRAMO))))
            .select(*resto, k.alias("k"), (k == F.col("ultimo")).alias("fin"),
                    F.expr(f"substring(t, CAST(i * {paso} + 1 AS INT), {trozo})").alias("t")))


def codificar(docs: DataFrame, ruta: str, patron: str, id_doc: str = "doc_id", texto: str = "text",
              trozo: int = TROZO, solape: int = SOLAPE) -> DataFrame:
    """(doc_id, ids): one row per input row, the ids of its whole text.

    Every text is cut into overlapping chunks, each of which is encoded on its own.  The chunks of a text of one stretch
    are cut, encoded and stitched in the task that reads the text.  The stretches of a longer one are dealt out to all
    tasks; only their chunks' ids are gathered by text to be stitched: the group is one text, and equal texts with one
    id are one group with a count.  A text whose chunks cannot be stitched is encoded whole.  Null or empty text has no
    ids.
    """
    if not 0 < 2 * solape <= trozo:
        raise ValueError("chunks must overlap by half at most")
    paso = trozo - solape
    tipo_id = docs.schema[id_doc].dataType
    salida = StructType([StructField("doc_id", tipo_id), StructField("ids", ArrayType(IntegerType()))])
    f = docs.select(F.col(id_doc).alias("doc_id"), F.coalesce(F.col(texto), F.lit("")).alias("t")).withColumn(
        "ultimo", _ultimo(trozo, solape))

    def en_su_tarea(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the chunks of a text follow each other; a text may go on in the next batch
        c, hechos, leidos = codificador(ruta, patron), [], []
        for lote in (x for y in lotes for x in cortar(y, 3)):
            fila = lote.column(0)
            t, fin = fila.field(3).to_pylist(), fila.field(2).to_pylist()
            piezas = [c.patron.findall(x) for x in t]
            c.aprender(piezas)
            ids = []
            for x, p, z in zip(t, piezas, fin):
                if z and not hechos:
                    ids.append(c.ids(p))
                    continue
                hechos.append(c.trozo(p, len(hechos), z, paso, solape))
                leidos.append(x if len(hechos) == 1 else x[solape:])
                if z:
                    cosido = coser(hechos)
                    ids.append(c.ids(c.patron.findall("".join(leidos))) if cosido is None else cosido)
                    hechos, leidos = [], []
            yield pa.RecordBatch.from_arrays([fila.field(0).filter(fila.field(2)), _lista(ids)], ["doc_id", "ids"])

    def por_trozos(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codificador(ruta, patron)
        for lote in (x for y in lotes for x in cortar(y, 4)):
            fila = lote.column(0)
            piezas = [c.patron.findall(t) for t in fila.field(4).to_pylist()]
            c.aprender(piezas)
            hechos = [c.trozo(x, k, z, paso, solape) for x, k, z in
                      zip(piezas, fila.field(2).to_pylist(), fila.field(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*[fila.field(j) for j in range(3)],
                                              *[_lista([h[n] for h in hechos]) for n in PARTES]], tipo_trozo.names)

    def unir(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lote in lotes:
            fila = lote.column(0)
            for i in range(lote.num_rows):
                x = fila.field(1).slice(i, 1).flatten()
                ids = coser([{n: x.field(n)[r].values.to_numpy(zero_copy_only=False) for n in PARTES}
                             for r in range(len(x))])
                lista = pa.nulls(1, pa.list_(pa.int32())) if ids is None else _lista([ids])
                yield pa.RecordBatch.from_arrays([fila.field(0).slice(i, 1), fila.field(2).slice(i, 1), lista,
                                                  fila.field(3).slice(i, 1)], ["doc_id", "clave", "ids", "veces"])

    def entero(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codificador(ruta, patron)
        for lote in (x for y in lotes for x in cortar(y, 1)):
            fila = lote.column(0)
            yield pa.RecordBatch.from_arrays(
                [fila.field(0), _lista([c.ids(c.patron.findall(t)) for t in fila.field(1).to_pylist()])], ["doc_id", "ids"])

    breves = f.filter(F.col("ultimo") < TROZOS_POR_TRAMO).withColumn("j", F.lit(0).cast("bigint"))
    salen = como_fila(_en_trozos(breves, trozo, solape)).mapInArrow(en_su_tarea, salida)
    largos = f.filter(F.col("ultimo") >= TROZOS_POR_TRAMO)
    if largos.isEmpty():
        return salen

    numeros = ArrayType(IntegerType())
    tipo_trozo = StructType([StructField("doc_id", tipo_id), StructField("clave", StringType()), StructField("k", LongType()),
                             *[StructField(n, numeros) for n in PARTES]])
    tipo_unido = StructType([StructField("doc_id", tipo_id), StructField("clave", StringType()),
                             StructField("ids", numeros), StructField("veces", LongType())])
    tramo = TROZOS_POR_TRAMO * paso
    clave = F.sha2(F.col("t").cast("binary"), 256)
    tramos = (largos.select("doc_id", clave.alias("clave"), "ultimo", "t")
              .withColumn("j", F.explode(F.sequence(F.lit(0), F.floor(F.col("ultimo") / TROZOS_POR_TRAMO))))
              .withColumn("t", F.expr(f"substring(t, CAST(j * {tramo} + 1 AS INT), {tramo + solape})"))
              .repartition("clave", "j"))
    # equal rows have equal chunks: one of each stays, with a count, before a text's chunks meet
    trozos = (como_fila(_en_trozos(tramos, trozo, solape)).mapInArrow(por_trozos, tipo_trozo)
              .groupBy("doc_id", "clave", "k").agg(*[F.first(n).alias(n) for n in PARTES], F.count("*").alias("veces")))
    juntos = trozos.groupBy("doc_id", "clave").agg(
        F.sort_array(F.collect_list(F.struct("k", *PARTES))).alias("trozos"), F.max("veces").alias("veces"))
    cosidos, _ = Corte(docs.sparkSession, "bpe").guardar(
        como_fila(juntos.select("doc_id", "trozos", "clave", "veces")).mapInArrow(unir, tipo_unido))
    salen = salen.unionByName(cosidos.filter("ids IS NOT NULL").select(
        "doc_id", "ids", F.explode(F.sequence(F.lit(1).cast("bigint"), "veces")).alias("vez")).drop("vez"))
    sueltos = cosidos.filter("ids IS NULL").select(F.col("doc_id").alias("d"), F.col("clave").alias("c"))
    if sueltos.isEmpty():
        return salen
    faltan = largos.join(sueltos, F.col("doc_id").eqNullSafe(F.col("d")) & (clave == F.col("c")), "left_semi")
    return salen.unionByName(como_fila(faltan.select("doc_id", "t")).mapInArrow(entero, salida))


def _lista(x: list[np.ndarray]) -> pa.ListArray:
    fin = np.cumsum([0, *map(len, x)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(fin), pa.array(np.concatenate(x) if x else np.zeros(0, np.int32), pa.int32()))


def resumir(ids: DataFrame, ruta: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): decodes the ids and digests both sides."""
    tipo = StructType([ids.schema["doc_id"], StructField("n_tokens", LongType()),
                       StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])
    sha = lambda a: pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in a], pa.string())

    def resumen(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tabla = por_trabajador(("tabla", ruta), lambda: Tabla(ruta))
        for lote in lotes:
            fila = lote.column(0)
            # a step is a bounded number of ids; a longer list is a step of its own
            fin = np.cumsum(pc.list_value_length(fila.field(1)).to_numpy(zero_copy_only=False))
            i = 0
            while i < len(fin):
                j = max(i + 1, int(np.searchsorted(fin, (fin[i - 1] if i else 0) + IDS_POR_PASO, "right")))
                v = pa.ListArray.from_arrays(pa.array(np.append(fin[i - 1] if i else 0, fin[i:j])
                                                      - (fin[i - 1] if i else 0), pa.int32()),
                                             fila.field(1).slice(i, j - i).flatten())
                dicho = pc.binary_join(pa.ListArray.from_arrays(v.offsets, v.values.cast(pa.string())), " ")
                yield pa.RecordBatch.from_arrays(
                    [fila.field(0).slice(i, j - i), pc.list_value_length(v).cast(pa.int64()), sha(dicho),
                     sha(tabla.textos(v))], tipo.names)
                i = j

    return como_fila(ids).mapInArrow(resumen, tipo)
