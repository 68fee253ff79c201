"""Oracle SQL: the same results written for DuckDB over the raw test tables."""

from __future__ import annotations

import re

# name -> (other tables it reads, text).  Only what a query needs is put in front of it.
_TABLAS: dict[str, str] = {
    "usuarios": """SELECT c_custkey AS id, c_name AS email, c_mktsegment AS rol, n_name AS ciudad, r_name AS pais,
        CAST(18 + c_custkey % 60 AS INT) AS edad
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "restaurantes": """SELECT s_suppkey AS id, s_name AS nombre, n_name AS ciudad, CAST(20 + s_suppkey % 81 AS INT) AS capacidad,
        CASE s_suppkey % 3 WHEN 0 THEN 'gourmet' WHEN 1 THEN 'fast-food' ELSE 'casual' END AS categoria_local,
        CAST(984033 + 100 * (s_suppkey % 40) AS DOUBLE) / 100000 AS lat,
        CAST(-8394037 + 100 * ((s_suppkey * 7) % 48) AS DOUBLE) / 100000 AS lon
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "menus": """SELECT p_partkey AS id, p_name AS titulo, p_type AS categoria, p_size % 2 = 0 AS activo,
        p_partkey % (SELECT COUNT(*) FROM supplier) AS restaurante_id FROM part""",
    "pedido_detalle": """SELECT l_orderkey AS pedido_id, l_partkey AS producto_id, CAST(l_quantity AS INT) AS cantidad,
        l_extendedprice AS subtotal, l_extendedprice / l_quantity AS precio_unitario FROM lineitem""",
    "pedidos": """SELECT o_orderkey AS id, o_custkey AS usuario_id, o_totalprice AS total,
        CASE o_orderstatus WHEN 'F' THEN 'completado' WHEN 'O' THEN 'cancelado' ELSE 'pendiente' END AS estado,
        o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)) AS fecha_creacion, menu_id, restaurante_id, cantidad
        FROM orders LEFT JOIN (SELECT l_orderkey, MIN(l_partkey) AS menu_id, MIN(l_suppkey) AS restaurante_id,
          CAST(SUM(l_quantity) AS BIGINT) AS cantidad FROM lineitem GROUP BY l_orderkey) x ON l_orderkey = o_orderkey""",
    "reservas": """SELECT 1000000000 + event_id AS id, user_id AS usuario_id,
        CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_id END AS pedido_id,
        CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS timestamp_reserva,
        CASE event_type WHEN 'purchase' THEN 'ACTIVE' WHEN 'view' THEN 'ACTIVE'
             WHEN 'error' THEN 'CANCELLED' ELSE 'PENDING' END AS estado,
        CAST(1 + CAST(json_extract_string(props, '$.k') AS INT) % 10 AS INT) AS invitados, p.menu_id, p.restaurante_id
        FROM events LEFT JOIN pedidos p ON p.id = event_id
        UNION ALL
        SELECT id, usuario_id, id, fecha_creacion, CASE WHEN id % 4 = 0 THEN 'CANCELLED' ELSE 'ACTIVE' END,
        CAST(1 + id % 10 AS INT), menu_id, restaurante_id FROM pedidos WHERE id % 5 <> 0""",
    "recomienda": """SELECT src, dst, canal, DATE '2024-01-01' + CAST(src % 365 AS INTEGER) AS fecha FROM (
        SELECT c_custkey AS src, (c_custkey * 7 + 3) % (SELECT COUNT(*) FROM customer) AS dst,
        CASE c_custkey % 3 WHEN 0 THEN 'email' WHEN 1 THEN 'app' ELSE 'social' END AS canal FROM customer
        UNION ALL
        SELECT (c_custkey * 7 + 3) % (SELECT COUNT(*) FROM customer), c_custkey, 'app'
        FROM customer WHERE c_custkey % 3 = 0) e WHERE src <> dst""",
    "calle": """SELECT c_custkey AS id, CAST(98400 + 10 * (c_custkey % 40) AS DOUBLE) / 10000 AS lat,
        CAST(-839400 + 10 * CAST(FLOOR(c_custkey / 40) AS BIGINT) AS DOUBLE) / 10000 AS lon FROM customer""",
    "road": """SELECT src, dst, distancia, CASE src % 6 WHEN 0 THEN NULL WHEN 1 THEN ''
        ELSE 'Calle ' || CAST(src % 23 AS VARCHAR) END AS nombre FROM (
        SELECT id AS src, id + 1 AS dst, CAST(100 + (id * 37) % 50 AS DOUBLE) AS distancia
        FROM calle WHERE id % 40 < 39 AND id + 1 IN (SELECT id FROM calle)
        UNION ALL
        SELECT id, id + 40, CAST(100 + (id * 53) % 50 AS DOUBLE) FROM calle WHERE id + 40 IN (SELECT id FROM calle)) e""",
    "via": """SELECT src, dst, MIN(distancia) AS w FROM (SELECT src, dst, distancia FROM road
        UNION ALL SELECT dst, src, distancia FROM road) GROUP BY 1, 2""",
    "clientes": """SELECT u.id, u.email, c.lat + CAST(u.id % 5 AS DOUBLE) / 100000 AS lat,
        c.lon - CAST(u.id % 3 AS DOUBLE) / 100000 AS lon FROM usuarios u JOIN calle c ON c.id = u.id""",
    "repartidores": """SELECT id, ciudad AS zona, lat, lon, id % 7 <> 3 AS activo, CAST(3 + id % 5 AS INT) AS capacidad_max,
        CAST(20 + id % 11 AS DOUBLE) AS velocidad_promedio, CAST(id % 3 AS INT) AS carga FROM restaurantes""",
    "pedidos_entrega": """SELECT p.id, p.usuario_id AS cliente_id, p.restaurante_id, r.ciudad AS zona, p.total, p.estado,
        CAST(10 + p.id % 16 AS INT) AS tiempo_preparacion, CAST(1 + p.id % 3 AS INT) AS prioridad, p.fecha_creacion
        FROM pedidos p JOIN restaurantes r ON r.id = p.restaurante_id""",
    "posiciones": """SELECT user_id % (SELECT COUNT(*) FROM supplier) AS repartidor_id,
        CAST(98400 + 10 * (event_id % 40) AS DOUBLE) / 10000 AS lat,
        CAST(-839400 + 10 * (event_id % 37) AS DOUBLE) / 10000 AS lon, ts, event_id AS secuencia FROM events""",
    # star schema
    "dim_tiempo": """SELECT DISTINCT epoch_us(timestamp_reserva) AS tiempo_id, timestamp_reserva AS fecha_reserva,
        CAST(timestamp_reserva AS DATE) AS fecha, CAST(year(timestamp_reserva) AS INT) AS ano,
        CAST(month(timestamp_reserva) AS INT) AS mes, CAST(day(timestamp_reserva) AS INT) AS dia,
        CAST(hour(timestamp_reserva) AS INT) AS hora, strftime(timestamp_reserva, '%B') AS nombre_mes_completo,
        strftime(timestamp_reserva, '%A') AS dia_semana FROM reservas WHERE timestamp_reserva IS NOT NULL""",
    "dim_usuario": "SELECT id AS usuario_id, email, rol FROM usuarios",
    "dim_restaurante": """SELECT id AS restaurante_id, nombre, categoria_local AS categoria, capacidad, lat, lon
        FROM restaurantes""",
    "dim_menu": """SELECT id AS menu_id, titulo AS titulo_menu, categoria AS categoria_menu, activo, restaurante_id
        FROM menus""",
    "hechos_reservas": """SELECT t.tiempo_id, r.usuario_id, r.restaurante_id, r.menu_id, p.total,
        r.estado AS estado_reserva, p.estado AS estado_pedido, r.invitados
        FROM reservas r LEFT JOIN pedidos p ON r.pedido_id = p.id
        JOIN dim_tiempo t ON t.fecha_reserva = r.timestamp_reserva""",
    # dashboard schema
    "fact_pedidos": """SELECT id AS id_pedido, epoch_us(fecha_creacion) AS id_tiempo, menu_id AS id_menu,
        restaurante_id AS id_restaurante, usuario_id AS id_usuario, total AS precio_total, cantidad, estado FROM pedidos""",
    "fact_reservas": "SELECT id AS id_reserva, usuario_id AS id_usuario, invitados AS numero_personas FROM reservas",
    "d_usuario": "SELECT id AS id_usuario, ciudad, pais, edad FROM usuarios",
    "d_menu": "SELECT id AS id_menu, titulo, categoria FROM menus",
    "d_restaurante": "SELECT id AS id_restaurante, nombre, ciudad FROM restaurantes",
    "d_tiempo": """SELECT DISTINCT epoch_us(fecha_creacion) AS id_tiempo, CAST(year(fecha_creacion) AS INT) AS anio,
        CAST(month(fecha_creacion) AS INT) AS mes, strftime(fecha_creacion, '%B') AS nombre_mes,
        CAST(dayofweek(fecha_creacion) + 1 AS INT) AS dia_semana, strftime(fecha_creacion, '%A') AS nombre_dia_semana,
        CAST(hour(fecha_creacion) AS INT) AS hora FROM pedidos""",
    # graph
    "incluye_detalle": """SELECT DISTINCT d.pedido_id AS src, d.producto_id AS dst, d.cantidad, d.precio_unitario, d.subtotal
        FROM pedido_detalle d JOIN orders o ON o.o_orderkey = d.pedido_id JOIN part m ON m.p_partkey = d.producto_id""",
    "co": """SELECT a.src, a.dst AS p1, b.dst AS p2, a.cantidad AS c1, b.cantidad AS c2, a.subtotal AS s1, b.subtotal AS s2
        FROM incluye_detalle a JOIN incluye_detalle b ON a.src = b.src AND a.dst < b.dst""",
    "compras": """SELECT DISTINCT o.o_custkey AS entidad, d.l_partkey AS item
        FROM lineitem d JOIN orders o ON o.o_orderkey = d.l_orderkey""",
    "influye": """SELECT e.src, e.dst, e.comunes * 1.0::DOUBLE / (n1.n + n2.n - e.comunes) AS score, e.comunes AS productos_comunes
        FROM (SELECT a.entidad AS src, b.entidad AS dst, COUNT(*) AS comunes
              FROM compras a JOIN compras b ON a.item = b.item AND a.entidad <> b.entidad GROUP BY 1, 2) e
        JOIN (SELECT entidad, COUNT(*) AS n FROM compras GROUP BY 1) n1 ON n1.entidad = e.src
        JOIN (SELECT entidad, COUNT(*) AS n FROM compras GROUP BY 1) n2 ON n2.entidad = e.dst
        WHERE e.comunes * 1.0::DOUBLE / (n1.n + n2.n - e.comunes) >= 0.05""",
}


def D(x: str) -> str:
    """Exact money sum as double."""
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def AV(x: str) -> str:
    return f"{D(x)} / NULLIF(COUNT({x}), 0)"


def B(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def _con_tablas(texto: str) -> str:
    """Prefixes the CTEs the text reads, in dependency order."""
    orden: list[str] = []

    def visitar(t: str) -> None:
        for nombre in re.findall(r"\b[a-z_]+\b", t):
            if nombre in _TABLAS and nombre not in orden and nombre != actual[-1]:
                actual.append(nombre)
                visitar(_TABLAS[nombre])
                actual.pop()
                if nombre not in orden:
                    orden.append(nombre)

    actual = [""]
    visitar(texto)
    ctes = [f"{n} AS ({_TABLAS[n]})" for n in orden]
    cuerpo = texto.strip()
    recursivo = "RECURSIVE " if re.match(r"WITH RECURSIVE", cuerpo) else ""
    m = re.match(r"WITH (RECURSIVE )?", cuerpo)
    if m:
        cuerpo = cuerpo[m.end():]
        sep = ", " if ctes else ""
        return f"WITH {recursivo}{', '.join(ctes)}{sep}{cuerpo}"
    return f"WITH {', '.join(ctes)} {cuerpo}" if ctes else cuerpo


_CONSULTAS: dict[str, str] = {}


def registrar(**textos: str) -> None:
    _CONSULTAS.update(textos)


def sql() -> dict[str, str]:
    from comanda.plans import oraculo_grafo, oraculo_rutas, oraculo_vistas, oraculo_vueltas  # noqa: F401  (they register)

    return {k: _con_tablas(v) for k, v in _CONSULTAS.items()}
