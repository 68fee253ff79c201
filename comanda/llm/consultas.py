"""Queries of the text operators over the test tables, and SQL that gives the same rows."""

from __future__ import annotations

import uuid
from functools import partial

import public_tokenizers as vocabularios
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.llm import (blanqueo, bpe, chat, descontaminacion, idioma, licencias, mejores, periodos, reglas, repair,
                         simhash, viterbi, warc)
from comanda.llm.comun import NO_BLANCO, leer
from comanda.plans.durable import Corte, carpeta_compartida


def _sha(c) -> Column:
    return F.sha2(c.cast("binary"), 256)


def op1_descontaminacion(spark: SparkSession, sf: str) -> DataFrame:
    m = descontaminacion.medir(leer(spark, sf, "documents").select("doc_id", "text"), leer(spark, sf, "benchmark"))
    return m.select(
        F.col("fila.doc_id").alias("doc_id"), F.col("n_palabras").alias("n_words"), F.col("n_dadas").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        _sha(F.array_join(F.array_sort("items"), ",")).alias("items_sha256"),
        F.col("contaminado").alias("contaminated"))


def op2_licencias(spark: SparkSession, sf: str) -> DataFrame:
    m = licencias.examinar(leer(spark, sf, "documents").select("doc_id", "text"))
    return m.select(
        F.col("fila.doc_id").alias("doc_id"), F.col("n_palabras").alias("n_words"),
        F.size("lugares").cast("bigint").alias("n_base"), F.array_min("lugares").alias("first_word"),
        F.array_max("lugares").alias("last_word"), F.array_join("base", ",").alias("base_labels"),
        F.array_join("etiquetas", ",").alias("labels"), F.col("puntos").alias("score"))


def op3_repair(spark: SparkSession, sf: str) -> DataFrame:
    codificador = partial(repair.tokens, vocabularios.path("word_bpe_49k.json"))
    return repair.leer(repair.escribir(leer(spark, sf, "documents"), codificador))


def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    carpeta = f"{carpeta_compartida(spark)}/warc_{uuid.uuid4().hex}"
    indice = warc.escribir(leer(spark, sf, "pages"), carpeta)
    return warc.leer(spark, indice, carpeta, payload=False).select(
        warc.numero_de("registro").alias("page_id"), F.col("largo").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.col("tipo").alias("record_type"),
        warc.numero_de("refiere").alias("refers_to"))


def op5_idioma(spark: SparkSession, sf: str) -> DataFrame:
    d = leer(spark, sf, "documents").select("doc_id", "text", "lang")
    resto = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    red = idioma.entrenar(idioma.muestra(d.filter(resto != 1)))
    m = idioma.predecir(d.select("doc_id", "text"), red).withColumn("doc_id", F.col("fila.doc_id"))
    return m.select("doc_id", F.coalesce(resto == 1, F.lit(False)).alias("held_out"), F.col("idioma").alias("lang_pred"),
                    F.col("puntos").alias("score"))


def op6_reglas(spark: SparkSession, sf: str) -> DataFrame:
    return reglas.evaluar(leer(spark, sf, "documents"), conservar=["doc_id"]).select(
        F.col("fila.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op7_conteo(spark: SparkSession, sf: str) -> DataFrame:
    m = viterbi.contar(leer(spark, sf, "documents").select("doc_id", "text"), vocabularios.path("piece_bpe_32k.model"))
    return m.select(F.col("fila.doc_id").alias("doc_id"), F.col("n_piezas").alias("n_tokens"))


def op8_bpe(spark: SparkSession, sf: str) -> DataFrame:
    rangos, patron = vocabularios.path("byte_bpe_50k.tiktoken"), vocabularios.PATTERN
    return bpe.resumir(bpe.codificar(leer(spark, sf, "documents"), rangos, patron), rangos)


def op9_chat(spark: SparkSession, sf: str) -> DataFrame:
    propia = "'<|im_end|><|im_start|>assistant ok'"
    prueba = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.expr("IF(id = 0, 'user', 'assistant')").alias("role"), F.expr(propia).alias("text"))
    conv = leer(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(prueba)
    # the pieces are written and read back as examples, each reply behind its whole context
    salida, _ = Corte(spark, "chat").guardar(chat.ejemplos(conv))
    entrena = chat.desescapar(F.substr("texto", F.col("desde") + 1, F.col("hasta") - F.col("desde")))
    # a digest of a conversation needs its text in one value
    g = chat.completos(salida).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("pieza", F.coalesce(entrena, F.lit("")).alias("entrena")))).alias("p"),
        F.max(F.when(F.col("ultima"), F.col("texto"))).alias("texto"))
    g = g.select("conv_id", F.array_join(F.col("p.entrena"), "").alias("entrena"), chat.turnos("texto").alias("turnos"),
                 F.length("texto").cast("bigint").alias("largo"))
    dicho = F.array_join(F.transform("turnos", lambda t: F.concat(t["rol"], F.lit("\n"), t["texto"], F.lit("\n"))), "")
    return g.select("conv_id", F.size("turnos").cast("bigint").alias("n_turns"), _sha(dicho).alias("turns_sha256"),
                    F.length("entrena").cast("bigint").alias("loss_chars"), _sha(F.col("entrena")).alias("loss_sha256"),
                    F.col("largo").alias("formatted_chars"))


def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    g = simhash.grupos(leer(spark, sf, "documents"))
    return g.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("huella"), 16, "0")).alias("fingerprint"),
                    F.col("grupo").alias("component_id"))


def _enteros(spark: SparkSession, sf: str, escala: int, suma: int) -> DataFrame:
    e = leer(spark, sf, "embeddings").select("vec_id", "embedding")
    return e.filter(blanqueo.sirve(F.col("embedding"))).select(
        "vec_id", blanqueo.enteros(F.col("embedding"), escala, suma).alias("x"))


def op11_mejores(spark: SparkSession, sf: str) -> DataFrame:
    m = mejores.mejores(_enteros(spark, sf, 1024, 0), F.col("vec_id") % 100 == 0, 10, "vec_id", "x")
    return m.select(F.col("consulta").alias("query_id"), F.col("puesto").alias("rank"), F.col("candidato").alias("vec_id"),
                    F.col("puntos").alias("score"))


def con_tramos_repetidos(docs: DataFrame) -> DataFrame:
    """The contract's texts: in one of ten, the words from a place on repeat a stretch of the text."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, w = F.floor(h / 10), F.col("w")
    # only the texts concerned are split into words here
    palabras = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({NO_BLANCO})"), F.lit(1)))
    m = docs.select("doc_id", "text", g.alias("g"), palabras.alias("w")).withColumn("n", F.size("w"))
    m = m.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))) \
        .withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    a, p = F.col("a"), F.col("p")
    lugar = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(
        a + (i - a) % p).cast("int")))
    return m.select("doc_id", F.when(a.isNull(), F.col("text")).otherwise(F.array_join(lugar, " ")).alias("text"))


def op12_periodos(spark: SparkSession, sf: str) -> DataFrame:
    m = periodos.buscar(con_tramos_repetidos(leer(spark, sf, "documents").select("doc_id", "text")))
    lineas = F.transform("corridas", lambda c: F.concat_ws(",", c["inicio"], c["largo"], c["periodo"]))
    # greatest length / period, compared without rounding; then smallest start and period
    mayor = F.aggregate("corridas", F.element_at("corridas", 1), lambda a, b: F.when(
        b["largo"] * a["periodo"] > a["largo"] * b["periodo"], b).otherwise(a))
    m = m.withColumn("m", F.when(F.size("corridas") > 0, mayor))
    return m.select(
        F.col("fila.doc_id").alias("doc_id"), F.size("corridas").cast("bigint").alias("n_runs"),
        F.col("m.inicio").alias("start"), F.col("m.largo").alias("length"), F.col("m.periodo").alias("period"),
        F.expr("1000 * m.largo div m.periodo").alias("exponent_milli"),
        _sha(F.concat(F.array_join(lineas, "\n"), F.when(F.size("corridas") > 0, "\n").otherwise("")))
        .alias("runs_sha256"), _sha(F.col("sin_repetir")).alias("collapsed_sha256"))


def op13_blanqueo(spark: SparkSession, sf: str) -> DataFrame:
    x = _enteros(spark, sf, 64, 1_000_000)
    m = blanqueo.ajustar(x, 32, 1_000_000)
    b = blanqueo.blanquear(x, m)
    error = blanqueo.error_identidad(b, m)
    explicado = F.array(*[F.lit(e).cast("double") for e in m.explicado]).cast("array<double>")
    return (b.select("fila.vec_id", "desvio", F.posexplode("blanqueado").alias("p", "whitened"))
            .select("vec_id", (F.col("p") + 1).alias("component"), F.lit(m.n).cast("bigint").alias("n"),
                    F.col("desvio").alias("deviation"), "whitened", F.get(explicado, F.col("p")).alias("explained"),
                    F.lit(error).cast("double").alias("identity_error")))


def consultas() -> dict:
    return {f.__name__: f for f in (op1_descontaminacion, op2_licencias, op3_repair, op4_warc, op5_idioma, op6_reglas,
                                   op7_conteo, op8_bpe, op9_chat, op10_simhash, op11_mejores,
                                   op12_periodos, op13_blanqueo)}
