"""Chat formatting: every assistant turn is an example whose context is all turns before it.

The contexts of a conversation are prefixes of one text.  An example therefore carries only what its
context adds to the one before (``formato``) and how long the shared prefix is (``prefijo``): the output
grows with the turns, not with their square.  ``contextos`` writes a prompt out in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ABRE, CIERRA = "<|im_start|>", "<|im_end|>\n"
#: Turn numbers of one block: no window or group holds more than a block of a conversation.
BLOQUE = 1024


def escapar(c: Column) -> Column:
    r"""Puts one ``\`` into every ``<|``, ``<\|``, ``<\\|`` ..., so no text holds a control string."""
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def desescapar(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", "<$1|")


def escapar_rol(c: Column) -> Column:
    """A role is one line of its turn's head."""
    return escapar(F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def desescapar_rol(c: Column) -> Column:
    return F.replace(F.replace(desescapar(c), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def ejemplos(conv: DataFrame, id_conv: str = "conv_id", turno: str = "turn", rol: str = "role",
             texto: str = "text") -> DataFrame:
    """(conv_id, ejemplo, bloque, prefijo, formato, desde, hasta).

    ``formato`` holds the turns after the example before, up to and with the reply; characters ``desde`` to
    ``hasta`` of it (from 0) are the reply, the only trainable part, and null in a piece without one.  The
    whole prompt is the conversation's first ``prefijo`` characters and ``formato`` up to ``desde``.  Turns
    after the last reply are a last piece with nothing to train.  A context that runs over blocks of
    ``BLOQUE`` turn numbers is a piece per block, ordered by ``bloque``.

    Rows go by turn, null first; equal turns by role, then text, and repeated rows are turns of their own.
    Null role or text is empty; a null conversation is a conversation.
    """
    f = conv.select(
        F.col(id_conv).alias("conv_id"), F.col(turno).alias("turno"),
        F.coalesce(F.floor(F.col(turno) / BLOQUE), F.lit(-(1 << 60))).cast("bigint").alias("bloque"),
        F.coalesce(F.col(rol), F.lit("")).alias("rol"), F.coalesce(F.col(texto), F.lit("")).alias("texto"))
    cuerpo = F.concat(F.lit(ABRE), escapar_rol(F.col("rol")), F.lit("\n"), escapar(F.col("texto")), F.lit(CIERRA))
    f = f.select("conv_id", "bloque", F.struct("turno", "rol", "texto").alias("orden"), cuerpo.alias("cuerpo"),
                 F.when(F.col("rol") == "assistant", 1).otherwise(0).alias("responde"))
    # what lies before a block, from one row a block
    previo = Window.partitionBy("conv_id").orderBy("bloque").rowsBetween(Window.unboundedPreceding, -1)
    antes = (f.groupBy("conv_id", "bloque")
             .agg(F.sum("responde").alias("r"), F.sum(F.length("cuerpo")).alias("l"))
             .select(F.col("conv_id").alias("c"), F.col("bloque").alias("b"),
                     F.coalesce(F.sum("r").over(previo), F.lit(0)).alias("r0"),
                     F.coalesce(F.sum("l").over(previo), F.lit(0)).alias("l0")))
    dentro = Window.partitionBy("conv_id", "bloque").orderBy("orden").rowsBetween(Window.unboundedPreceding, -1)
    f = f.select("conv_id", "bloque", "orden", "cuerpo", "responde",
                 F.coalesce(F.sum("responde").over(dentro), F.lit(0)).alias("r1"),
                 F.coalesce(F.sum(F.length("cuerpo")).over(dentro), F.lit(0)).alias("l1"))
    f = f.join(antes, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("bloque") == F.col("b")))
    ultimo = F.element_at("turnos", -1)
    pieza = (f.groupBy("conv_id", "bloque", (F.col("r0") + F.col("r1")).alias("ejemplo"))
             .agg(F.min(F.col("l0") + F.col("l1")).alias("prefijo"), F.max("responde").alias("responde"),
                  F.sort_array(F.collect_list(F.struct("l1", "orden", "cuerpo"))).alias("turnos"))
             .select("conv_id", "ejemplo", "bloque", "prefijo", "responde",
                     F.array_join(F.col("turnos.cuerpo"), "").alias("formato"),
                     F.length(ultimo["cuerpo"]).alias("largo"),
                     F.length(escapar(ultimo["orden"]["texto"])).alias("respuesta")))
    hasta = F.length("formato") - len(CIERRA)
    trae = F.col("responde") == 1
    return pieza.select("conv_id", "ejemplo", "bloque", "prefijo", "formato",
                        F.when(trae, hasta - F.col("respuesta")).cast("bigint").alias("desde"),
                        F.when(trae, hasta).cast("bigint").alias("hasta"))


def turnos(texto: str) -> Column:
    """The turns (rol, texto) of a formatted text, unescaped."""
    partes = F.filter(F.split(texto, r"<\|im_end\|>\n"), lambda x: x != "")
    rol = lambda x: desescapar_rol(F.substr(F.substring_index(x, "\n", 1), F.lit(len(ABRE) + 1)))
    dicho = lambda x: desescapar(F.substr(x, F.length(F.substring_index(x, "\n", 1)) + 2))
    return F.transform(partes, lambda x: F.struct(rol(x).alias("rol"), dicho(x).alias("texto")))


def leidos(salida: DataFrame) -> DataFrame:
    """What the written pieces say: per piece its turns (role, text) and the trainable text, unescaped."""
    entrena = desescapar(F.substr("formato", F.col("desde") + 1, F.col("hasta") - F.col("desde")))
    return salida.select("conv_id", "ejemplo", "bloque", "prefijo", F.length("formato").cast("bigint").alias("largo"),
                         turnos("formato").alias("turnos"), entrena.alias("entrena"))


def completos(salida: DataFrame) -> DataFrame:
    """Every example in full: (conv_id, pieza, texto, desde, hasta, ultima).

    ``texto`` is the whole conversation up to and with the piece, so a reply stands behind all turns before it;
    characters ``desde`` to ``hasta`` of it, found by the piece's ``prefijo``, are the reply and null in a piece without
    one.  ``ultima`` marks the piece that ends the conversation.  A conversation's pieces are one value; its examples,
    whose characters grow with the square of the turns, are rows made one after the other and never shuffled by this.
    """
    c = (salida.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "ejemplo", "bloque", "prefijo", "formato", "desde", "hasta"))).alias("p"))
        .select("conv_id", "p", F.explode(F.sequence(F.lit(1), F.size("p"))).alias("pieza")))
    esta = F.element_at("p", F.col("pieza"))
    return c.select("conv_id", "pieza", F.array_join(F.slice("p.formato", F.lit(1), F.col("pieza")), "").alias("texto"),
                    (esta["prefijo"] + esta["desde"]).alias("desde"), (esta["prefijo"] + esta["hasta"]).alias("hasta"),
                    (F.col("pieza") == F.size("p")).alias("ultima"))


def contextos(salida: DataFrame, hasta_turnos: DataFrame) -> DataFrame:
    """(conv_id, ejemplo, contexto, respuesta) in full for the chosen ``hasta_turnos(conv_id, ejemplo)``."""
    e = hasta_turnos.select(F.col("conv_id").alias("c"), F.col("ejemplo").alias("e")).distinct()
    j = salida.join(e, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("ejemplo") <= F.col("e")))
    propia = (F.col("ejemplo") == F.col("e")) & F.col("desde").isNotNull()
    parte = F.when(propia, F.substr("formato", F.lit(1), F.col("desde"))).otherwise(F.col("formato"))
    responde = F.when(propia, F.substr("formato", F.col("desde") + 1, F.col("hasta") - F.col("desde")))
    return (j.groupBy("c", "e").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("ejemplo", "bloque", parte.alias("p"))))["p"], "")
        .alias("contexto"), F.max(responde).alias("respuesta"))
        .select(F.col("c").alias("conv_id"), F.col("e").alias("ejemplo"), "contexto", "respuesta"))
