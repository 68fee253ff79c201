"""Oracle SQL of the spatial, path and delivery operators: brute force over all pairs."""

from comanda.plans.oraculo import registrar

# nearest node of every restaurant by Manhattan degrees
ANCLA = """ancla AS (SELECT id, nodo FROM (SELECT r.id, c.id AS nodo, row_number() OVER (PARTITION BY r.id
    ORDER BY abs(r.lat - c.lat) + abs(r.lon - c.lon), c.id) AS k FROM restaurantes r, calle c) WHERE k = 1)"""
PARES = """pares AS (SELECT DISTINCT a.nodo AS origen, c.id AS destino FROM pedidos p JOIN ancla a ON a.id = p.restaurante_id
    JOIN calle c ON c.id = p.usuario_id)"""


def _cercana(tabla: str, radio: str) -> str:
    """Nearest node in planar metres within a radius, NULL beyond it."""
    return f"""SELECT p.id, n.calle_id, n.d AS distancia FROM {tabla} p LEFT JOIN (
        SELECT id, calle_id, d FROM (SELECT p.id, c.id AS calle_id,
          sqrt((p.lat - c.lat) * (p.lat - c.lat) + (p.lon - c.lon) * (p.lon - c.lon)) * 111000 AS d,
          row_number() OVER (PARTITION BY p.id ORDER BY sqrt((p.lat - c.lat) * (p.lat - c.lat)
            + (p.lon - c.lon) * (p.lon - c.lon)), c.id) AS k FROM {tabla} p, calle c) WHERE k = 1 AND d < {radio}) n
        ON n.id = p.id"""


def _saltos(tope: int) -> str:
    """All walks level by level, keeping the shortest per origin, node and number of segments."""
    return f"""nivel AS (SELECT DISTINCT nodo AS origen, nodo, 0 AS h, CAST(0 AS DOUBLE) AS d FROM ancla
        UNION ALL SELECT n.origen, v.dst, n.h + 1, MIN(n.d + v.w) FROM nivel n JOIN via v ON v.src = n.nodo
        WHERE n.h < {tope} GROUP BY 1, 2, 3),
        corta AS (SELECT origen, nodo, arg_min(d, h) AS d, MIN(h) AS h FROM nivel GROUP BY 1, 2)"""


def _ruta(tope: int) -> str:
    return f"""WITH RECURSIVE {ANCLA}, {PARES}, {_saltos(tope)},
        ruta AS (SELECT p.origen, p.destino, c.h, c.d FROM pares p JOIN corta c ON c.origen = p.origen
        AND c.nodo = p.destino)"""


def _camino(tope: int) -> str:
    """The nodes of each path, k segments from its origin: of equally good predecessors the smallest one, from the end back."""
    return f"""{_ruta(tope)},
        previo AS (SELECT c.origen, c.nodo, MIN(v.src) AS pred FROM corta c JOIN via v ON v.dst = c.nodo
          JOIN corta b ON b.origen = c.origen AND b.nodo = v.src AND b.h = c.h - 1 AND b.d + v.w = c.d GROUP BY 1, 2),
        atras AS (SELECT origen, destino, destino AS nodo, h AS k, h, d FROM ruta
          UNION ALL SELECT a.origen, a.destino, p.pred, a.k - 1, a.h, a.d FROM atras a
          JOIN previo p ON p.origen = a.origen AND p.nodo = a.nodo WHERE a.k > 0)"""


#: Each node of a path with its place, and the street to the next one.
PASOS = f"""{_camino(100)},
    calle_entre AS (SELECT src, dst, distancia, nombre FROM road UNION ALL SELECT dst, src, distancia, nombre FROM road),
    pasos AS (SELECT a.origen, a.destino, a.h, CAST(a.k + 1 AS INT) AS paso, a.nodo AS nodo_id, c.lat AS latitud, c.lon AS longitud,
      CASE WHEN a.k = a.h THEN 'DESTINO' ELSE e.nombre END AS calle, CASE WHEN a.k = a.h THEN 0.0::DOUBLE ELSE e.distancia END
        AS distancia_m
      FROM atras a JOIN calle c ON c.id = a.nodo LEFT JOIN atras b ON b.origen = a.origen AND b.destino = a.destino AND b.k = a.k + 1
      LEFT JOIN calle_entre e ON e.src = a.nodo AND e.dst = b.nodo)"""


MATRIZ = f"""WITH RECURSIVE {ANCLA}, {_saltos(100)}, m AS (SELECT r.id AS rid, r.nombre AS restaurante, k.id AS kid, k.email AS cliente, c.h
    FROM corta c JOIN ancla a ON a.nodo = c.origen JOIN restaurantes r ON r.id = a.id JOIN clientes k ON k.id = c.nodo)"""

registrar(
    g07_alcance="""WITH RECURSIVE inicio AS (SELECT id FROM calle ORDER BY id LIMIT 100),
        a AS (SELECT id, 0 AS h FROM inicio WHERE id IN (SELECT src FROM via)
          UNION SELECT v.dst, a.h + 1 FROM a JOIN via v ON v.src = a.id WHERE a.h < 5)
        SELECT COUNT(DISTINCT id) AS conectadas, (SELECT COUNT(*) FROM inicio WHERE id IN (SELECT src FROM via)) AS total FROM a""",
    r02_anclar_restaurantes=f"WITH {ANCLA} SELECT id AS src, nodo AS dst, 0 AS distancia FROM ancla",
    g10_conectividad_restaurantes=f"""WITH {ANCLA}, g AS (SELECT unnest([src, dst]) AS n FROM road)
        SELECT id, nombre, nodo AS osm_node_id, COUNT(g.n) AS conexiones,
          IF(COUNT(g.n) > 0, 'CONECTADO', 'AISLADO') AS estado
        FROM ancla JOIN restaurantes USING (id) LEFT JOIN g ON g.n = nodo GROUP BY id, nombre, nodo""",
    r03_calle_mas_cercana=_cercana("clientes", "5000"),
    r04_registrar_clientes=f"SELECT * FROM ({_cercana('clientes', '2')}) WHERE calle_id IS NOT NULL",
    r04_clientes_rechazados=f"""SELECT * FROM clientes WHERE id IN (SELECT id FROM ({_cercana('clientes', '2')})
        WHERE calle_id IS NULL)""",
    r05_ruta_mas_corta=f"{_ruta(20)} SELECT origen, destino, h AS num_calles, d AS distancia, h + 1 AS nodos FROM ruta",
    r06_ruta_hasta_100=f"""WITH RECURSIVE {ANCLA}, {PARES}, {_saltos(100)}
        SELECT p.origen, p.destino, c.h AS segmentos FROM pares p JOIN corta c ON c.origen = p.origen AND c.nodo = p.destino""",
    r07_ruta_menor_distancia=f"""WITH RECURSIVE {ANCLA}, {PARES}, {_saltos(110)}
        SELECT p.origen, p.destino, MIN(n.d) AS distancia FROM pares p
        JOIN nivel n ON n.origen = p.origen AND n.nodo = p.destino GROUP BY 1, 2""",
    r12_carga_tras_entregas="""SELECT r.id, CAST(COUNT(p.id) AS INT) AS carga FROM repartidores r
        LEFT JOIN pedidos_entrega p ON p.restaurante_id = r.id
          AND p.id NOT IN (SELECT event_id FROM events WHERE event_type = 'purchase') GROUP BY 1""",
    r13_ultima_posicion="""SELECT r.id, COALESCE(u.lat, r.lat) AS lat, COALESCE(u.lon, r.lon) AS lon FROM repartidores r
        LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY repartidor_id ORDER BY ts DESC, secuencia DESC) AS k
                   FROM posiciones) u ON u.repartidor_id = r.id AND u.k = 1""",
    r14_registrar_repartidores=f"SELECT id, calle_id AS calle_actual FROM ({_cercana('repartidores', '1000')})",
    r15_matriz_conectividad=f"""{MATRIZ} SELECT r.id AS restaurante_id, r.nombre AS restaurante, k.id AS cliente_id,
        k.email AS cliente, COALESCE(m.h, 0) AS segmentos,
        CASE WHEN m.h IS NULL THEN 'SIN RUTA' ELSE 'CONECTADO' END AS estado
        FROM restaurantes r CROSS JOIN clientes k LEFT JOIN m ON m.rid = r.id AND m.kid = k.id""",
    r16_rutas_cortas=f"{MATRIZ} SELECT restaurante, cliente, h AS segmentos FROM m ORDER BY h, rid, kid LIMIT 5",
    r16_rutas_largas=f"{MATRIZ} SELECT restaurante, cliente, h AS segmentos FROM m ORDER BY h DESC, rid, kid LIMIT 5",
    r17_segmentos_por_restaurante=f"""{MATRIZ} SELECT restaurante, ROUND(AVG(h), 2) AS segmentos_promedio,
        MIN(h) AS min_segmentos, MAX(h) AS max_segmentos FROM m GROUP BY rid, restaurante""",
    r18_restaurante_centrico=f"{MATRIZ} SELECT restaurante, ROUND(AVG(h), 2) AS promedio_segmentos FROM m GROUP BY rid, 1",
    r18_cliente_accesible=f"{MATRIZ} SELECT cliente, ROUND(AVG(h), 2) AS promedio_segmentos FROM m GROUP BY kid, 1",
    r19_prueba_conectividad=f"""{MATRIZ} SELECT COUNT(*) AS rutas_exitosas,
        (SELECT COUNT(*) FROM restaurantes) * (SELECT COUNT(*) FROM clientes) AS rutas_totales FROM m""",
    r05_coordenadas=f"""{_camino(20)} SELECT origen, destino, h AS num_calles, d AS distancia,
        string_agg(CAST(nodo AS VARCHAR), ',' ORDER BY k) AS calles,
        string_agg(CAST(lat AS VARCHAR) || ' ' || CAST(lon AS VARCHAR), ',' ORDER BY k) AS coordenadas
        FROM atras JOIN calle ON calle.id = nodo GROUP BY origen, destino, h, d""",
    r20_primeros_pasos=f"""{PASOS} SELECT origen, destino, paso, nodo_id, latitud, longitud, calle, distancia_m FROM pasos
        WHERE paso <= 10""",
    r20_detalle_de_ruta=f"""{PASOS} SELECT origen, destino, h AS total_segmentos,
        string_agg(CAST(nodo_id AS VARCHAR) || ' ' || CAST(latitud AS VARCHAR) || ' ' || CAST(longitud AS VARCHAR), ',' ORDER BY paso)
          AS nodos,
        COALESCE(string_agg(COALESCE(calle, '-') || ' ' || CAST(distancia_m AS VARCHAR), ',' ORDER BY paso)
          FILTER (WHERE paso <= h), '') AS calles FROM pasos GROUP BY origen, destino, h""",
    r22_resumen_de_ruta=f"""{_ruta(100)} SELECT origen, destino, a.lat AS lat_origen, a.lon AS lon_origen, b.lat AS lat_destino,
        b.lon AS lon_destino, ROUND(d / 10) / 100 AS distancia_km, ROUND(d * 0.6::DOUBLE / 30) / 10 AS tiempo_estimado_min,
        h AS segmentos FROM ruta JOIN calle a ON a.id = origen JOIN calle b ON b.id = destino""",
)
