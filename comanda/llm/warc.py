"""WARC archives: one gzip member a record, written and read by tasks; the reader splits files anywhere.

A range of a file is scanned for the gzip magic.  A candidate counts if it inflates to a whole record with a
WARC header whose length fits; the record belongs to the range it starts in and is read past the range's end.
Bytes go through ``pyarrow.fs``, which opens local, HDFS, S3 and GCS addresses, so the folder must be one that
every executor reaches: by default that of ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.llm.comun import como_fila, unir_repartido
from comanda.plans.durable import Corte

MAGIA = b"\x1f\x8b\x08"
PERFIL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of a file that one reading task owns, and how many it fetches at a time.
RANGO = 8 << 20
LECTURA = 1 << 20
FECHA = "1970-01-01T00:00:00Z"


def registro(ident: str, uri: str | None, sha1: str, largo: int, html: bytes | None, refiere: str | None,
             fecha: str = FECHA, nivel: int = 6) -> bytes:
    """One gzip member: a response with its payload, or a revisit that carries the response's head only."""
    bloque = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % largo
    campos = ["WARC/1.1", f"WARC-Type: {'response' if refiere is None else 'revisit'}",
              f"WARC-Record-ID: <urn:x-page:{ident}>", f"WARC-Date: {fecha}",
              "WARC-Target-URI: " + quote(uri or "about:blank", safe="%:/?#[]@!$&'()*+,;=~"),
              "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode(),
              "Content-Type: application/http; msgtype=response"]
    if refiere is not None:
        campos += [f"WARC-Profile: {PERFIL}", f"WARC-Refers-To: <urn:x-page:{refiere}>"]
    else:
        bloque += html or b""
    campos.append(f"Content-Length: {len(bloque)}")
    g = zlib.compressobj(nivel, zlib.DEFLATED, 31)
    return g.compress("\r\n".join(campos).encode() + b"\r\n\r\n" + bloque + b"\r\n\r\n") + g.flush()


def decidir(paginas: DataFrame, id_pagina: str, html: str, minimo: int = 0) -> tuple[DataFrame, DataFrame]:
    """(rows by key with payload, decisions by key).  A key is an id with a payload; equal rows share one.

    Of equal payloads of ``minimo`` bytes or more the largest id is the response; a null id is smaller than
    any.  Groups are found on digests alone, and a digest that a large share of the rows has is joined apart.
    """
    d = paginas.select(
        F.col(id_pagina).cast("bigint").alias("id"), "url", F.coalesce(F.col(html), F.lit("")).alias("html"))
    d = d.withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    d = d.withColumn("clave", F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("")), "sha1"))
    corte = Corte(paginas.sparkSession, "warc")
    k, total = corte.guardar(d.groupBy("clave").agg(
        F.max("id").alias("id"), F.max("sha1").alias("sha1"), F.max(F.octet_length("html")).alias("largo")))
    por_sha = k.groupBy("sha1").agg(F.max("id").alias("respuesta"), F.count("*").alias("n"))
    dec = unir_repartido(k, por_sha, "sha1", "n", total)
    propia = F.col("id").eqNullSafe(F.col("respuesta"))
    dec, _ = corte.guardar(dec.select(
        "clave", "id", "sha1", "largo", "respuesta", (propia | (F.col("largo") < minimo)).alias("responde"),
        (F.col("largo") < minimo).alias("breve")))
    filas = d.groupBy("clave").agg(F.max("html").alias("html"), F.min("url").alias("url"), F.count("*").alias("veces"))
    return filas, dec


def escribir(paginas: DataFrame, carpeta: str, id_pagina: str = "page_id", html: str = "html", minimo: int = 0,
             nivel: int = 4) -> DataFrame:
    """Writes the archives and returns their manifest (ruta, largo, registros).

    A file name carries a fresh mark, and the manifest names only files of tasks that succeeded: what a lost
    or repeated task leaves behind is never read.  Null html is an empty payload, null url ``about:blank``.
    Rows repeated in id and html are one response and revisits of it.
    """
    filas, dec = decidir(paginas, id_pagina, html, minimo)
    cuerpo = F.when(F.col("responde"), F.col("html"))
    df = filas.join(dec, "clave").select("id", "url", "sha1", "largo", "respuesta", "responde", "breve", "veces",
                                         cuerpo.alias("html"))

    def guardar(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sistema, raiz = fs.FileSystem.from_uri(carpeta)
        ruta = f"{raiz}/parte-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        salida, n, largo = None, 0, 0
        for lote in lotes:
            for f in lote.column(0):
                r = f.as_py()
                nombre, otro = ("" if x is None else str(x) for x in (r["id"], r["respuesta"]))
                for copia in range(r["veces"]):
                    primera = r["responde"] and (copia == 0 or r["breve"])
                    b = registro(f"{nombre}:{copia}", r["url"], r["sha1"], r["largo"],
                                 r["html"].encode() if primera else None, None if primera else f"{otro}:0", nivel=nivel)
                    if salida is None:
                        salida = sistema.open_output_stream(ruta, compression=None)
                    salida.write(b)
                    n, largo = n + 1, largo + len(b)
        if salida is not None:
            salida.close()
            yield pa.RecordBatch.from_pydict({"ruta": [ruta], "largo": [largo], "registros": [n]})

    # the folder is made once here; tasks only add files
    sistema, raiz = fs.FileSystem.from_uri(carpeta)
    sistema.create_dir(raiz, recursive=True)
    manifiesto = como_fila(df).mapInArrow(guardar, "ruta string, largo bigint, registros bigint")
    return Corte(paginas.sparkSession, "warc_indice").guardar(manifiesto)[0]


class Rango:
    """Bytes of a file from ``desde`` on, fetched as they are needed."""

    def __init__(self, archivo, desde: int, largo: int):
        self.archivo, self.base, self.largo = archivo, desde, largo
        self.datos = b""

    def trae(self, hasta: int) -> bool:
        """Makes bytes up to ``hasta`` available; False if the file ends before."""
        fin = self.base + len(self.datos)
        if fin < min(hasta, self.largo):
            self.archivo.seek(fin)
            self.datos += self.archivo.read(max(hasta - fin, LECTURA))
        return hasta <= self.base + len(self.datos)

    def suelta(self, hasta: int) -> None:
        self.datos, self.base = self.datos[hasta - self.base:], hasta

    def busca(self, desde: int, hasta: int) -> int:
        """Place of the next magic that starts before ``hasta``, or -1."""
        while desde < hasta:
            self.suelta(desde)
            self.trae(min(desde + LECTURA, hasta + len(MAGIA) - 1))
            tope = min(self.base + len(self.datos), hasta + len(MAGIA) - 1)
            i = self.datos.find(MAGIA, 0, tope - self.base)
            if i >= 0:
                return self.base + i
            if tope >= min(hasta + len(MAGIA) - 1, self.largo) or tope - desde < len(MAGIA):
                return -1
            desde = tope - len(MAGIA) + 1
        return -1


def leer_miembro(r: Rango, p: int) -> tuple[dict[str, str], bytes, int] | None:
    """(header, block, end) of the record whose member starts at ``p``, None if none does."""
    z = zlib.decompressobj(31)
    partes, n, en = [], 0, p
    try:
        while not z.eof:
            r.trae(en + 1)
            trozo = r.datos[en - r.base: en - r.base + (4096 if not n else LECTURA)]
            if not trozo:
                return None
            x = z.decompress(trozo)
            en += len(trozo) - len(z.unused_data)
            if not n and x and not (x.startswith(b"WARC/1.") or b"WARC/1.".startswith(x)):
                return None
            partes.append(x)
            n += len(x)
    except zlib.error:
        return None
    cabeza, punto, bloque = b"".join(partes).partition(b"\r\n\r\n")
    if not punto or not cabeza.startswith(b"WARC/1."):
        return None
    campos = dict(c.partition(": ")[::2] for c in cabeza.decode("utf-8", "replace").split("\r\n")[1:])
    largo = campos.get("Content-Length", "")
    if not largo.isdigit() or len(bloque) != int(largo) + 4 or not bloque.endswith(b"\r\n\r\n"):
        return None
    return campos, bloque[:-4], en


def registros_de(archivo, desde: int, hasta: int, largo: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records whose members start in [desde, hasta)."""
    r = Rango(archivo, desde, largo)
    while (p := r.busca(desde, hasta)) >= 0:
        m = leer_miembro(r, p)
        if m is None:
            desde = p + 1
        else:
            yield m[0], m[1]
            desde = m[2]


SALIDA = "registro string, tipo string, uri string, largo bigint, digest string, refiere string, payload binary"


def leer(spark: SparkSession, manifiesto: DataFrame, carpeta: str, rango: int = RANGO, payload: bool = True) -> DataFrame:
    """One row a record: id, type, URI, length and digest (base32 SHA-1) of the full payload, referred id, payload.

    Length and digest of a response are those of the bytes read; a revisit states them in its header.  A member
    that breaks off or is no WARC record is passed over.
    """
    partes = manifiesto.select("ruta", "largo", F.explode(F.expr(
        f"sequence(0L, (greatest(largo, 1L) - 1) div {rango})")).alias("k"))
    tareas = int(manifiesto.agg(F.sum((F.col("largo") + rango - 1) / rango)).first()[0] or 1)
    partes = partes.repartition(max(1, min(tareas, 100_000)), "ruta", "k")

    def tarea(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sistema, _ = fs.FileSystem.from_uri(carpeta)
        for lote in lotes:
            for f in lote.column(0):
                x = f.as_py()
                with sistema.open_input_file(x["ruta"]) as a:
                    filas, bytes_ = [], 0
                    for c, bloque in registros_de(a, x["k"] * rango, min((x["k"] + 1) * rango, x["largo"]), x["largo"]):
                        http, _, cuerpo = bloque.partition(b"\r\n\r\n")
                        revisita = c["WARC-Type"] == "revisit"
                        if revisita:
                            largo = int(http.lower().partition(b"content-length: ")[2].split(b"\r\n")[0])
                            digest = c["WARC-Payload-Digest"].removeprefix("sha1:")
                        else:
                            largo = len(cuerpo)
                            digest = base64.b32encode(hashlib.sha1(cuerpo).digest()).decode()
                        filas.append((c["WARC-Record-ID"], c["WARC-Type"], c.get("WARC-Target-URI"), largo, digest,
                                      c.get("WARC-Refers-To"), cuerpo if payload and not revisita else None))
                        bytes_ += len(cuerpo)
                        if bytes_ > LECTURA or len(filas) >= 5000:
                            yield _lote(filas)
                            filas, bytes_ = [], 0
                    if filas:
                        yield _lote(filas)

    return como_fila(partes).mapInArrow(tarea, SALIDA)


_TIPOS = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]


def _lote(filas: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*filas), _TIPOS)],
                                      [c.split()[0] for c in SALIDA.split(", ")])


def numero_de(c):
    """Page id inside a record id of ``registro``; null where the page had none."""
    return F.expr(f"try_cast(regexp_extract({c}, 'x-page:(-?[0-9]*):', 1) AS BIGINT)")
