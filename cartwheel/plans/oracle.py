"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from cartwheel.functions.vectors import hyperplanes
from cartwheel.operators import grid
from cartwheel.plans.queries import SAMPLE, SEED, WINDOWS
from cartwheel.plans.tables import BASKET_K, HISTORY, LAST_YEAR, TOP_K, VECTOR_SCALE

N_FACTORS = HISTORY.n_factors
N_TABLES, N_FUNCTIONS = HISTORY.n_hash_tables, HISTORY.n_hash_functions

# Building blocks: name -> (blocks it reads, body).
PARTS: dict[str, tuple[list[str], str]] = {}


def part(name: str, needs: str, body: str) -> None:
    PARTS[name] = (needs.split(), body)


def sql(needs: str, body: str) -> str:
    """A query with the building blocks it needs, each defined once and in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for other in PARTS[name][0]:
                visit(other)
            order.append(name)

    for name in needs.split():
        visit(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({PARTS[n][1]})" for n in order) + "\n" + body


def in_window(config, column: str = "datestamp") -> str:
    if config.num_days is None:
        return f"{column} IS NOT NULL"
    end = f"DATE '{config.end_date}'"
    return f"CAST({column} AS DATE) BETWEEN {end} - {config.num_days - 1} AND {end}"


part(
    "purchases",
    "",
    """SELECT o_custkey AS network_userid, l_orderkey AS order_id, l_partkey AS item_id,
       l_quantity AS item_quantity, o_orderdate AS datestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)


def interactions_of(config) -> str:
    return f"""SELECT network_userid, order_id, item_id,
       avg(CAST(CAST(item_quantity AS FLOAT) AS DOUBLE)) AS item_quantity,
       strftime(datestamp, '%Y_%m_%d') AS date_partition
  FROM purchases
 WHERE {in_window(config)} AND network_userid IS NOT NULL AND item_id IS NOT NULL
 GROUP BY network_userid, order_id, item_id, strftime(datestamp, '%Y_%m_%d')"""


part("interactions", "purchases", interactions_of(HISTORY))
part("interactions_year", "purchases", interactions_of(LAST_YEAR))
part(
    "cut",
    "interactions",
    f"""SELECT min(date_partition) AS first_test
  FROM (SELECT date_partition, row_number() OVER (ORDER BY date_partition) AS nr, count(*) OVER () AS n
          FROM (SELECT DISTINCT date_partition FROM interactions) d) p
 WHERE nr > floor(n * (1 - CAST({HISTORY.test_fraction} AS DOUBLE)))""",
)
for side, comparison in (("train", "<"), ("test", ">=")):
    part(
        side,
        "interactions cut",
        f"""SELECT network_userid AS user_id, item_id, avg(item_quantity) AS rating
  FROM interactions WHERE date_partition {comparison} (SELECT first_test FROM cut)
 GROUP BY network_userid, item_id""",
    )
part("user_ids", "interactions", "SELECT DISTINCT network_userid AS user_id FROM interactions")
part("item_ids", "interactions", "SELECT DISTINCT item_id FROM interactions")
part("user_idx", "user_ids", "SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS INT) AS user_idx FROM user_ids")
part("item_idx", "item_ids", "SELECT item_id, CAST(row_number() OVER (ORDER BY item_id) - 1 AS INT) AS item_idx FROM item_ids")

part("mean", "train", "SELECT avg(rating) AS mu FROM train")
part(
    "item_bias",
    "train mean",
    f"""SELECT item_id, sum(rating - mu) / (count(*) + {HISTORY.bias_damping}) AS bias
  FROM train, mean GROUP BY item_id""",
)
part(
    "user_bias",
    "train mean item_bias",
    f"""SELECT user_id, sum(rating - mu - bias) / (count(*) + {HISTORY.bias_damping}) AS bias
  FROM train JOIN item_bias USING (item_id), mean GROUP BY user_id""",
)
part(
    "vectors",
    "",
    "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, (SELECT count(*) FROM embeddings) AS n FROM embeddings",
)


def parameters(ids: str, key: str, bias: str, first: int) -> str:
    return f"""SELECT x.{key},
       list_transform(a.v[{first}:{first + 7}] || b.v[{first + 8}:{first + 15}], lambda e: e * {VECTOR_SCALE}) AS features,
       coalesce(y.bias, 0) AS bias
  FROM {ids} x
  JOIN vectors a ON a.vec_id = x.{key} % a.n
  JOIN vectors b ON b.vec_id = (x.{key} * 3 + x.{key} // b.n) % b.n
  LEFT JOIN {bias} y ON y.{key} = x.{key}"""


part("users", "user_ids vectors user_bias", parameters("user_ids", "user_id", "user_bias", 17))
part("items", "item_ids vectors item_bias", parameters("item_ids", "item_id", "item_bias", 1))

SCORE = "mu + u.bias + i.bias + list_dot_product(u.features, i.features)"
part(
    "predictions",
    "test users items mean",
    f"""SELECT user_id, item_id, rating, {SCORE} AS prediction
  FROM test JOIN users u USING (user_id) JOIN items i USING (item_id), mean""",
)
part(
    "scored",
    "users items mean",
    f"SELECT u.user_id, i.item_id, round({SCORE}, 8) AS score FROM users u, items i, mean",
)


def ranked_scores(source: str) -> str:
    return f"""SELECT * FROM (
  SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS INT) AS rank,
         item_id, score FROM {source}) r WHERE rank <= {TOP_K}"""


part("best", "scored", ranked_scores("scored"))
part("unseen", "scored train", "SELECT scored.* FROM scored ANTI JOIN train USING (user_id, item_id)")
part(
    "user_metrics",
    "best test",
    f"""SELECT t.user_id, count(*) AS n_relevant, count(r.rank) AS hits,
       coalesce(sum(t.rating / log2(r.rank + 1))
         / nullif(sum(CASE WHEN t.nr <= {TOP_K} THEN t.rating / log2(t.nr + 1) END), 0), 0) AS ndcg
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC) AS nr FROM test) t
  LEFT JOIN best r ON r.user_id = t.user_id AND r.item_id = t.item_id
 GROUP BY t.user_id""",
)
part(
    "user_sample",
    "interactions",
    f"""SELECT DISTINCT network_userid, md5(network_userid || '|{SEED}') AS digest FROM interactions
 ORDER BY digest, network_userid LIMIT {SAMPLE}""",
)
part(
    "test_sample",
    "test",
    f"""SELECT DISTINCT user_id, md5(user_id || '|{SEED}') AS digest FROM test ORDER BY digest, user_id LIMIT {SAMPLE}""",
)


def summary(where: str) -> str:
    return f"""SELECT (SELECT round(sqrt(avg((prediction - rating) * (prediction - rating))), 6) FROM predictions) AS rmse,
       round(coalesce(avg(ndcg), 0), 6) AS ndcg_at_10, round(coalesce(avg(hits / {TOP_K}), 0), 6) AS precision_at_10,
       round(coalesce(avg(hits / n_relevant), 0), 6) AS recall_at_10, count(*) AS num_users_evaluated,
       CAST({TOP_K} AS INT) AS k
  FROM user_metrics {where}"""


# Hyperplanes as rows of list literals, one per table and function.
def plane_rows() -> str:
    planes = hyperplanes(N_FACTORS, N_TABLES, N_FUNCTIONS, HISTORY.lsh_seed)
    rows = []
    for t in range(N_TABLES):
        for f in range(N_FUNCTIONS):
            numbers = ", ".join(f"{float(x)!r}" for x in planes[t, :, f])
            rows.append(f"({t}, {f}, CAST([{numbers}] AS DOUBLE[]))")
    return "SELECT * FROM (VALUES " + ",\n".join(rows) + ") AS p(table_idx, f, plane)"


part("planes", "", plane_rows())


def hashed(source: str, key: str) -> str:
    return f"""SELECT CAST(table_idx AS INT) AS table_idx, {key},
       string_agg(CASE WHEN list_dot_product(features, plane) > 0 THEN '1' ELSE '0' END, '' ORDER BY f) AS hash_key
  FROM {source}, planes GROUP BY table_idx, {key}"""


def cosine(a: str, b: str) -> str:
    norm = "(sqrt(list_dot_product({0}, {0})) + 1e-8)"
    return f"round(list_dot_product({a}, {b}) / ({norm.format(a)} * {norm.format(b)}), 8) + 0"


part("buckets", "items planes", hashed("items", "item_id"))


def ranked_candidates(key: str, k: str) -> str:
    """Rank (key, item_id, score) rows of `c`."""
    return f"""SELECT {key}, CAST(rank AS INT) AS rank, item_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY score DESC, item_id) AS rank FROM c) r WHERE rank <= {k}"""


def item_neighbors(k: int, keep_self: bool) -> str:
    return f"""SELECT * FROM (WITH c AS (
  SELECT p.query_id, p.item_id, {cosine("q.features", "i.features")} AS score
    FROM (SELECT DISTINCT a.item_id AS query_id, b.item_id FROM buckets a
            JOIN buckets b ON a.table_idx = b.table_idx AND a.hash_key = b.hash_key
           WHERE {'true' if keep_self else 'a.item_id <> b.item_id'}) p
    JOIN items q ON q.item_id = p.query_id JOIN items i ON i.item_id = p.item_id)
{ranked_candidates("query_id", str(k))}) n"""


part("neighbors_all", "buckets items", item_neighbors(TOP_K, keep_self=True))
part("neighbors_others", "buckets items", item_neighbors(BASKET_K, keep_self=False))
part(
    "popularity",
    "items",
    """SELECT item_id, round(bias, 8) AS score, row_number() OVER (ORDER BY round(bias, 8) DESC, item_id) AS pop_rank
  FROM items""",
)
BASKET_ITEM = "CASE WHEN l_returnflag = 'R' THEN -1 - l_partkey ELSE l_partkey END"
part(
    "order_lines",
    "",
    f"SELECT l_orderkey AS basket_id, {BASKET_ITEM} AS item_id, {BASKET_K} AS top_k FROM lineitem",
)
part(
    "request_rows",
    "",
    f"""SELECT event_id AS basket_id, CAST(CASE event_type
         WHEN 'error' THEN NULL
         WHEN 'signup' THEN []
         WHEN 'click' THEN [k, k, user_id]
         WHEN 'purchase' THEN [k, -1 - user_id]
         ELSE [k, user_id] END AS BIGINT[]) AS basket,
       CASE event_type WHEN 'view' THEN 3 ELSE {BASKET_K} END AS top_k
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) e""",
)
# An empty basket keeps one line without an item.
part(
    "request_lines",
    "request_rows",
    """SELECT basket_id, unnest(CASE WHEN len(basket) = 0 THEN [NULL] ELSE basket END) AS item_id, top_k
  FROM request_rows WHERE basket IS NOT NULL""",
)


def basket_parts(name: str, lines: str) -> None:
    means = ", ".join(f"coalesce(avg(features[{i}]), 0)" for i in range(1, N_FACTORS + 1))
    part(
        f"{name}_vectors",
        f"{lines} items",
        f"""SELECT basket_id, max(top_k) AS top_k, count(features) AS n_known, CAST([{means}] AS DOUBLE[]) AS features
  FROM {lines} LEFT JOIN items USING (item_id) GROUP BY basket_id""",
    )
    part(f"{name}_keys", f"{name}_vectors planes", hashed(f"{name}_vectors", "basket_id"))
    part(
        f"{name}_similar",
        f"{name}_keys {name}_vectors buckets items {lines}",
        f"""SELECT * FROM (WITH c AS (
  SELECT p.basket_id, p.item_id, q.top_k, {cosine("q.features", "i.features")} AS score
    FROM (SELECT DISTINCT a.basket_id, b.item_id FROM {name}_keys a
            JOIN buckets b ON a.table_idx = b.table_idx AND a.hash_key = b.hash_key) p
    ANTI JOIN {lines} l ON l.basket_id = p.basket_id AND l.item_id = p.item_id
    JOIN {name}_vectors q ON q.basket_id = p.basket_id JOIN items i ON i.item_id = p.item_id)
{ranked_candidates("basket_id", "top_k")}) n""",
    )
    part(
        f"{name}_recs",
        f"{name}_similar {name}_vectors popularity {lines}",
        f"""SELECT basket_id, rank, item_id, score, 'similarity' AS source FROM {name}_similar
UNION ALL
SELECT basket_id, CAST(n_found + nr AS INT), item_id, score, 'popularity' FROM (
  SELECT n.basket_id, n.n_found, n.top_k, p.item_id, p.score,
         row_number() OVER (PARTITION BY n.basket_id ORDER BY p.pop_rank) AS nr
    FROM (SELECT v.basket_id, v.top_k, count(s.rank) AS n_found FROM {name}_vectors v
            LEFT JOIN {name}_similar s ON s.basket_id = v.basket_id GROUP BY v.basket_id, v.top_k) n
   CROSS JOIN popularity p
    ANTI JOIN (SELECT basket_id, item_id FROM {lines} UNION SELECT basket_id, item_id FROM {name}_similar) t
      ON t.basket_id = n.basket_id AND t.item_id = p.item_id
   WHERE n.n_found < n.top_k) f
 WHERE n_found + nr <= top_k""",
    )


basket_parts("order", "order_lines")
basket_parts("request", "request_lines")

part("pairs_of_order", "purchases", "SELECT DISTINCT order_id, item_id FROM purchases")
part("n_orders", "pairs_of_order", "SELECT count(DISTINCT order_id) AS n FROM pairs_of_order")
MIN_COUNT = "(SELECT CAST(ceil(1e-4 * n) AS BIGINT) FROM n_orders)"


part(
    "itemsets",
    "pairs_of_order n_orders",
    f"""SELECT items, count(*) AS freq FROM (
  WITH RECURSIVE subsets AS (
    SELECT order_id, [item_id] AS items, item_id AS largest FROM pairs_of_order
    UNION ALL
    SELECT s.order_id, list_append(s.items, p.item_id), p.item_id FROM subsets s
      JOIN pairs_of_order p ON p.order_id = s.order_id AND p.item_id > s.largest)
  SELECT items FROM subsets) every GROUP BY items HAVING count(*) >= {MIN_COUNT}""",
)
part(
    "rules",
    "itemsets n_orders",
    """SELECT list_filter(s.items, lambda x: x <> c.item) AS antecedent, c.item AS consequent, s.freq
  FROM itemsets s, unnest(s.items) AS c(item) WHERE len(s.items) > 1""",
)
part(
    "monthly",
    "interactions user_bias item_bias mean",
    """SELECT run_id, round(sqrt(avg(e * e)), 6) AS rmse, sqrt(avg(e * e)) AS raw, count(*) AS n_pairs FROM (
  SELECT substr(date_partition, 1, 7) AS run_id,
         mu + coalesce(u.bias, 0) + coalesce(i.bias, 0) - item_quantity AS e
    FROM interactions x LEFT JOIN user_bias u ON u.user_id = x.network_userid
    LEFT JOIN item_bias i ON i.item_id = x.item_id, mean) d GROUP BY run_id""",
)


# Gradient training: a keyed recursion, one step for the same batch of all cells of a stratum, and one to judge an epoch.
D, EPOCHS, BATCH = HISTORY.n_factors, HISTORY.epochs, HISTORY.batch_size
RATE, DECAY = HISTORY.learning_rate, HISTORY.reg_lambda


def initial_rows(kind: str, ids: str, key: str) -> str:
    digest = f"md5('{key}|' || {key} || '|' || d || '|{SEED}')"
    uniform = f"CAST(CAST('0x' || substr({digest}, 1, 8) AS BIGINT) AS DOUBLE) / {16**8}.0"
    return f"""SELECT '{kind}' AS kind, {key} AS id, d::BIGINT AS d,
       CASE WHEN d < {D} THEN ({uniform} * 2 - 1) * sqrt(6 / ((SELECT count(*) FROM {ids}) + {D})) ELSE 0 END AS w,
       0.0::DOUBLE AS m, 0.0::DOUBLE AS v, 0::BIGINT AS t
  FROM {ids}, range({D + 1}) r(d)"""


def block_number(key: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 7) AS BIGINT) % (SELECT b FROM n_blocks)"


part(
    "n_blocks",
    "train user_ids item_ids",
    f"""SELECT greatest(1, least({grid.MOST_SPREAD}, (SELECT min(b) FROM range(1000000) r(b), (SELECT count(*) AS n FROM train) c
                       WHERE b * b * {grid.CELL_BATCHES * BATCH} >= n)),
       CAST(ceil((SELECT count(*) FROM user_ids) / {grid.BLOCK_ROWS}) AS BIGINT),
       CAST(ceil((SELECT count(*) FROM item_ids) / {grid.BLOCK_ROWS}) AS BIGINT)) AS b""",
)
part(
    "batches",
    "train n_blocks",
    f"""SELECT *, dense_rank() OVER (ORDER BY epoch, stratum, j) + epoch - 1 AS step FROM (
  SELECT *, (row_number() OVER (PARTITION BY epoch, ub, stratum ORDER BY md5(user_id || '|' || item_id || '|' || epoch || '|{SEED}'))
             - 1) // {BATCH} AS j
    FROM (SELECT *, (ib - ub + (SELECT b FROM n_blocks)) % (SELECT b FROM n_blocks) AS stratum
            FROM (SELECT *, {block_number("user_id")} AS ub, {block_number("item_id")} AS ib FROM train) a) b,
         range(1, {EPOCHS + 1}) r(epoch)) c""",
)
part("judged", "batches", "SELECT epoch, max(step) + 1 AS step FROM batches GROUP BY epoch")

PREDICTED = f"sum(CASE WHEN p.d < {D} THEN p.w * q.w ELSE p.w + q.w END)"
STEP = "(SELECT step FROM turn)"
TRAINING = f"""SELECT * FROM (
WITH RECURSIVE state(kind, id, d, w, m, v, t) USING KEY (kind, id, d) AS (
  {initial_rows("u", "user_ids", "user_id")}
  UNION ALL {initial_rows("i", "item_ids", "item_id")}
  UNION ALL SELECT 'step', 0::BIGINT, 0::BIGINT, 1.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0::BIGINT
  UNION ALL SELECT 'rate', 0::BIGINT, 0::BIGINT, {RATE}::DOUBLE, 'inf'::DOUBLE, 0.0::DOUBLE, 0::BIGINT
  UNION (
  WITH turn AS MATERIALIZED (SELECT CAST(w AS BIGINT) AS step FROM state WHERE kind = 'step'),
  now AS MATERIALIZED (SELECT * FROM recurring.state),
  own AS MATERIALIZED (SELECT ub, user_id, item_id, rating FROM batches WHERE step = {STEP}),
  errors AS MATERIALIZED (
    SELECT o.ub, o.user_id, o.item_id, any_value(mu) + {PREDICTED} - any_value(o.rating) AS e
      FROM own o JOIN now p ON p.kind = 'u' AND p.id = o.user_id JOIN now q ON q.kind = 'i' AND q.id = o.item_id AND q.d = p.d, mean
     GROUP BY o.ub, o.user_id, o.item_id),
  sizes AS MATERIALIZED (SELECT ub, count(*) AS n FROM own GROUP BY ub),
  slopes AS MATERIALIZED (
    SELECT e.ub, 'u' AS kind, e.user_id AS id, q.d, sum(2 / n * e * CASE WHEN q.d < {D} THEN q.w ELSE 1 END) AS g
      FROM errors e JOIN sizes USING (ub) JOIN now q ON q.kind = 'i' AND q.id = e.item_id GROUP BY e.ub, e.user_id, q.d
    UNION ALL
    SELECT e.ub, 'i', e.item_id, p.d, sum(2 / n * e * CASE WHEN p.d < {D} THEN p.w ELSE 1 END)
      FROM errors e JOIN sizes USING (ub) JOIN now p ON p.kind = 'u' AND p.id = e.user_id GROUP BY e.ub, e.item_id, p.d),
  clips AS MATERIALIZED (SELECT ub, least(1, 1 / (sqrt(sum(g * g)) + 1e-6)) AS clip FROM slopes GROUP BY ub),
  moments AS (
    SELECT kind, id, d, w, 0.9::DOUBLE * m + 0.1::DOUBLE * g2 AS m, 0.999::DOUBLE * v + 0.001::DOUBLE * g2 * g2 AS v, t + 1 AS t
      FROM (SELECT now.*, g * clip + {DECAY} * w AS g2 FROM slopes JOIN clips USING (ub) JOIN now USING (kind, id, d)) a),
  judged_now AS MATERIALIZED (SELECT epoch FROM judged WHERE step = {STEP}),
  losses AS MATERIALIZED (
    SELECT avg(e * e) AS loss FROM (
      SELECT any_value(mu) + {PREDICTED} - any_value(x.rating) AS e
        FROM (SELECT test.* FROM test, judged_now) x JOIN now p ON p.kind = 'u' AND p.id = x.user_id
        JOIN now q ON q.kind = 'i' AND q.id = x.item_id AND q.d = p.d, mean GROUP BY x.user_id, x.item_id) a),
  rates AS MATERIALIZED (
    SELECT CASE WHEN waited > 3 THEN rate * 0.5 ELSE rate END AS rate, best, CASE WHEN waited > 3 THEN 0 ELSE waited END AS waiting FROM (
      SELECT w AS rate, CASE WHEN loss < m * (1 - 1e-4::DOUBLE) THEN loss ELSE m END AS best,
             CASE WHEN loss < m * (1 - 1e-4::DOUBLE) THEN 0 ELSE v + 1 END AS waited
        FROM now, losses, judged_now WHERE kind = 'rate') a)
  SELECT kind, id, d, w - (SELECT w FROM now WHERE kind = 'rate') * (m / (1 - 0.9::DOUBLE ** t)) / (sqrt(v / (1 - 0.999::DOUBLE ** t)) + 1e-8),
         m, v, t FROM moments
  UNION ALL SELECT 'square', {STEP}, 0, (SELECT sum(e * e) FROM errors), 0, 0, 0 FROM turn WHERE EXISTS (SELECT 1 FROM own)
  UNION ALL SELECT 'loss', epoch, 0, loss, rate, 0, 0 FROM judged_now, losses, rates
  UNION ALL SELECT 'rate', 0, 0, rate, best, waiting, 0 FROM rates
  UNION ALL SELECT 'step', 0, 0, step + 1, 0, 0, 0 FROM turn WHERE step < (SELECT max(step) FROM judged)
  )) SELECT kind, id, w, m FROM state WHERE kind IN ('square', 'loss')) trained"""
part("training", "train test user_ids item_ids mean batches judged", TRAINING)
part(
    "curve",
    "training batches train",
    """SELECT l.id AS epoch, s.squares / (SELECT count(*) FROM train) AS train_loss, l.w AS test_loss, l.m AS rate
  FROM training l JOIN (SELECT epoch, sum(w) AS squares FROM training JOIN (SELECT DISTINCT epoch, step FROM batches) b ON b.step = id
                         WHERE kind = 'square' GROUP BY epoch) s ON s.epoch = l.id
 WHERE l.kind = 'loss'""",
)


# Alternating least squares: a keyed recursion over half steps, each of which eliminates all its systems one column at a time.
def als_parts(triples: str, rank: int, iterations: int, reg: float) -> str:
    r = range(1, rank + 1)
    number = f"CAST(CAST('0x' || substr(md5(id || '|' || d || '|{SEED}'), 1, 8) AS BIGINT) AS DOUBLE) / {16**8}.0"
    vector = ", ".join(f"n.x[{a}] AS x{a}" for a in r)
    cells = [(a, b) for a in r for b in r if a <= b]
    sums = [f"sum(x{a} * x{b})" + (f" + {reg} * count(*)" if a == b else "") + f" AS g{a}_{b}" for a, b in cells]
    sums += [f"sum(x{a} * rating) AS h{a}" for a in r]
    steps = []
    for k in r:  # take column k out of the rows below, of which the upper triangle is enough
        new = [f"g{a}_{b} - g{k}_{a} * g{k}_{b} / g{k}_{k} AS g{a}_{b}" if a > k else f"g{a}_{b}" for a, b in cells]
        new += [f"h{a} - g{k}_{a} * h{k} / g{k}_{k} AS h{a}" if a > k else f"h{a}" for a in r]
        steps.append(f"m{k} AS MATERIALIZED (SELECT kind, id, {', '.join(new)} FROM m{k - 1}),")
    for k in reversed(r):  # and put the numbers in, last one first
        known = "".join(f" - g{k}_{b} * y{b}" for b in range(k + 1, rank + 1))
        steps.append(f"b{k} AS MATERIALIZED (SELECT *, (h{k}{known}) / g{k}_{k} AS y{k} FROM {f'b{k + 1}' if k < rank else f'm{rank}'}),")
    below = "\n  ".join(steps)
    return f"""SELECT * FROM (
WITH RECURSIVE solved(kind, id, half, x) USING KEY (kind, id) AS (
  SELECT 'i' AS kind, id, 0::BIGINT AS half, list(({number} * 2 - 1) / sqrt({rank}::DOUBLE) ORDER BY d) AS x
    FROM (SELECT DISTINCT item_idx::BIGINT AS id FROM {triples}) a, range({rank}) b(d) GROUP BY id
  UNION (
  WITH turn AS MATERIALIZED (SELECT max(half) + 1 AS half, CASE max(half) % 2 WHEN 0 THEN 'i' ELSE 'u' END AS known FROM solved),
  now AS MATERIALIZED (SELECT s.* FROM recurring.solved s JOIN turn ON s.kind = turn.known WHERE turn.half <= {2 * iterations}),
  pairs AS (SELECT 'u' AS kind, user_idx::BIGINT AS id, t.rating, {vector} FROM {triples} t JOIN now n ON n.kind = 'i' AND n.id = t.item_idx
            UNION ALL
            SELECT 'i', item_idx, t.rating, {vector} FROM {triples} t JOIN now n ON n.kind = 'u' AND n.id = t.user_idx),
  m0 AS MATERIALIZED (SELECT kind, id, {", ".join(sums)} FROM pairs GROUP BY kind, id),
  {below}
  done AS (SELECT kind, id, [{", ".join(f"y{a}" for a in r)}] AS x FROM b1)
  SELECT done.kind, id, half, x FROM done, turn)
) SELECT kind, id, x FROM solved) s"""


part(
    "residuals",
    "train user_idx item_idx user_bias item_bias mean",
    """SELECT user_idx, item_idx, rating - (mu + i.bias + u.bias) AS rating
  FROM train JOIN item_bias i USING (item_id) JOIN user_bias u USING (user_id) JOIN user_idx USING (user_id)
  JOIN item_idx USING (item_id), mean""",
)
part("als", "residuals", als_parts("residuals", N_FACTORS, HISTORY.epochs, HISTORY.reg_lambda))
for kind, ids, key in (("u", "user", "user_id"), ("i", "item", "item_id")):
    part(
        f"als_{ids}s",
        f"{ids}_idx als {ids}_bias",
        f"""SELECT x.{key}, coalesce(a.x, list_transform(range({N_FACTORS}), lambda z: 0.0::DOUBLE)) AS features, coalesce(b.bias, 0) AS bias
  FROM {ids}_idx x LEFT JOIN als a ON a.kind = '{kind}' AND a.id = x.{ids}_idx LEFT JOIN {ids}_bias b ON b.{key} = x.{key}""",
    )
part(
    "als_scored",
    "als_users als_items mean",
    f"SELECT u.user_id, i.item_id, round({SCORE}, 8) AS score FROM als_users u, als_items i, mean",
)


def text(array: str) -> str:
    return f"array_to_string({array}, ',')"


def vector_text(array: str, scale: int = 10**6) -> str:
    return text(f"list_transform({array}, lambda x: CAST(round(x * {scale}, 0) AS BIGINT))")


RECS = "SELECT basket_id, rank, item_id, round(score, 8) AS score, source FROM {}_recs"

ORACLE: dict[str, str] = {
    "purchase_extract_distinct": """SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS datestamp, l_orderkey AS order_id,
       o_totalprice AS order_value, l_partkey AS item_id, p_brand AS item_brand, p_retailprice AS item_price,
       l_quantity AS item_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
 WHERE l_returnflag = 'A' AND l_linestatus = 'F' AND CAST(o_orderdate AS DATE) >= DATE '2001-08-01' - INTERVAL 12 MONTH""",
    "purchases_window": sql(
        "purchases",
        f"""SELECT network_userid, order_id, item_id, CAST(CAST(item_quantity AS FLOAT) AS DOUBLE) AS item_quantity,
       strftime(datestamp, '%Y_%m_%d') AS date_partition
  FROM purchases WHERE {in_window(LAST_YEAR)} AND network_userid IS NOT NULL AND item_id IS NOT NULL""",
    ),
    "order_item_quantity": sql("interactions", "SELECT * FROM interactions"),
    "csv_extract": sql("interactions_year", "SELECT * FROM interactions_year"),
    "extraction_audit": sql(
        "purchases interactions_year",
        f"""SELECT count(*) AS initial_count, count(*) FILTER (WHERE {in_window(LAST_YEAR)}) AS filtered_count,
       round(count(*) FILTER (WHERE {in_window(LAST_YEAR)}) / count(*) * 100, 6) AS filtered_pct,
       (SELECT count(*) FROM interactions_year) AS aggregated_count
  FROM purchases""",
    ),
    "partition_summary": sql(
        "interactions",
        """SELECT count(DISTINCT date_partition) AS n_partitions, min(date_partition) AS first_partition,
       max(date_partition) AS last_partition, count(*) AS n_rows FROM interactions""",
    ),
    "chrono_split": sql(
        "interactions cut",
        """SELECT date_partition, count(*) AS n_rows,
       CASE WHEN date_partition < (SELECT first_test FROM cut) THEN 'train' ELSE 'test' END AS side
  FROM interactions GROUP BY date_partition""",
    ),
    "hash_split": sql(
        "interactions",
        f"""SELECT network_userid, order_id, item_id,
       CASE WHEN substr(md5(network_userid || '|' || order_id || '|' || item_id || '|{SEED}'), 1, 8) < '{int(0.2 * 16 ** 8):08x}'
            THEN 'test' ELSE 'train' END AS side FROM interactions""",
    ),
    "user_sample": sql("user_sample", "SELECT network_userid FROM user_sample"),
    "user_index": sql("user_idx", "SELECT user_id, user_idx FROM user_idx"),
    "item_index": sql("item_idx", "SELECT item_id, item_idx FROM item_idx"),
    **{
        f"ratings_{side}": sql(
            f"{side} user_idx item_idx",
            f"""SELECT user_idx, item_idx, round(rating, 6) AS rating
  FROM {side} JOIN user_idx USING (user_id) JOIN item_idx USING (item_id)""",
        )
        for side in ("train", "test")
    },
    "ratings_moved_window": sql(
        "interactions_year",
        f"""SELECT network_userid AS user_id, item_id, round(avg(item_quantity), 6) AS rating FROM interactions_year
 WHERE date_partition BETWEEN '{WINDOWS[-1][0]}' AND '{WINDOWS[-1][1]}' GROUP BY network_userid, item_id""",
    ),
    "frequency_index": sql(
        "purchases",
        """SELECT CAST(item_id AS VARCHAR) AS item_id, count(*) AS frequency,
       row_number() OVER (ORDER BY count(*) DESC, CAST(item_id AS VARCHAR)) - 1 AS item_idx
  FROM purchases GROUP BY CAST(item_id AS VARCHAR)""",
    ),
    "one_hot_brand": f"""WITH b AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS brand_idx,
                  count(*) OVER () AS n FROM part GROUP BY p_brand)
SELECT p_partkey AS item_id, p_brand AS item_brand, brand_idx,
       {text("list_transform(range(n - 1), lambda x: CASE WHEN x = brand_idx THEN 1 ELSE 0 END)")} AS brand_vec
  FROM part JOIN b USING (p_brand)""",
    "bias_model": sql(
        "user_bias item_bias mean",
        """SELECT 'user' AS kind, user_id AS id, round(bias, 6) AS bias FROM user_bias
UNION ALL SELECT 'item', item_id, round(bias, 6) FROM item_bias
UNION ALL SELECT 'mean', -1, round(mu, 6) FROM mean""",
    ),
    "predict_pairs_test": sql(
        "predictions",
        "SELECT user_id, item_id, round(rating, 6) AS rating, round(prediction, 6) AS prediction FROM predictions",
    ),
    "rmse_test": sql(
        "predictions",
        """SELECT round(sqrt(avg((prediction - rating) * (prediction - rating))), 6) AS rmse, count(*) AS n_pairs
  FROM predictions""",
    ),
    "rmse_by_quantity": sql(
        "purchases cut users items mean",
        f"""SELECT round(l.rating, 6) AS rating,
       round(sqrt(avg(({SCORE} - l.rating) * ({SCORE} - l.rating))), 6) AS rmse,
       count(*) AS n_pairs, round(ln(count(*) + 1), 6) AS log_count
  FROM (SELECT network_userid AS user_id, item_id, CAST(CAST(item_quantity AS FLOAT) AS DOUBLE) AS rating
          FROM purchases
         WHERE datestamp IS NOT NULL AND strftime(datestamp, '%Y_%m_%d') >= (SELECT first_test FROM cut)) l
  JOIN users u USING (user_id) JOIN items i USING (item_id), mean
 WHERE l.rating IS NOT NULL GROUP BY l.rating""",
    ),
    "user_topk": sql("best", "SELECT user_id, rank, item_id, round(score, 8) AS score FROM best"),
    "user_topk_unseen": sql(
        "unseen", f"SELECT user_id, rank, item_id, round(score, 8) AS score FROM ({ranked_scores('unseen')}) b"
    ),
    "ndcg_per_user": sql("user_metrics", "SELECT user_id, round(ndcg, 6) AS ndcg_at_10 FROM user_metrics"),
    "precision_recall_per_user": sql(
        "user_metrics",
        f"""SELECT user_id, n_relevant, hits, round(hits / {TOP_K}, 6) AS precision_at_10,
       round(hits / n_relevant, 6) AS recall_at_10 FROM user_metrics""",
    ),
    "evaluation_summary": sql("user_metrics predictions", summary("")),
    "evaluation_sampled": sql(
        "user_metrics predictions test_sample", summary("WHERE user_id IN (SELECT user_id FROM test_sample)")
    ),
    "embedding_lookup": sql(
        "items order_lines",
        f"""SELECT item_id, {vector_text("features")} AS vector
  FROM (SELECT DISTINCT item_id FROM order_lines) a LEFT JOIN items USING (item_id)""",
    ),
    "lsh_buckets": sql("buckets", "SELECT table_idx, hash_key, item_id FROM buckets"),
    "lsh_neighbors": sql("neighbors_all", "SELECT query_id, rank, item_id, round(score, 8) AS score FROM neighbors_all"),
    "similar_items_all": sql(
        "neighbors_others popularity order_lines items",
        f"""SELECT query_id, rank, item_id, round(score, 8) AS score, 'similarity' AS source FROM neighbors_others
 WHERE query_id IN (SELECT item_id FROM order_lines)
UNION ALL
SELECT a.item_id, CAST(pop_rank AS INT), p.item_id, round(score, 8), 'popularity'
  FROM (SELECT DISTINCT item_id FROM order_lines) a ANTI JOIN items USING (item_id)
  CROSS JOIN popularity p WHERE pop_rank <= {BASKET_K}""",
    ),
    "basket_embeddings": sql(
        "order_vectors", f"SELECT basket_id, n_known, {vector_text('features')} AS vector FROM order_vectors"
    ),
    "popularity_topk": sql(
        "popularity", "SELECT item_id, round(score, 8) AS score FROM popularity ORDER BY pop_rank LIMIT 100"
    ),
    "popularity_topk_excluding": sql(
        "popularity",
        """SELECT item_id, round(score, 8) AS score FROM popularity
 WHERE item_id NOT IN (SELECT p_partkey FROM part WHERE p_brand IN ('Brand#1', 'Brand#2'))
 ORDER BY pop_rank LIMIT 100""",
    ),
    "basket_recommendations": sql("order_recs", RECS.format("order")),
    "request_recommendations": sql("request_recs", RECS.format("request")),
    "stream_basket_recommendations": sql("request_recs", RECS.format("request")),
    "basket_responses": sql(
        "request_recs request_rows",
        f"""SELECT r.basket_id, {text("r.basket")} AS basket,
       CASE WHEN r.basket IS NOT NULL THEN coalesce({text("a.items")}, '') END AS items,
       CASE WHEN r.basket IS NOT NULL THEN coalesce({vector_text("a.scores", 10**8)}, '') END AS scores,
       CASE WHEN r.basket IS NULL THEN 'basket is missing' END AS error
  FROM request_rows r LEFT JOIN (
    SELECT basket_id, list(item_id ORDER BY rank) AS items, list(score ORDER BY rank) AS scores
      FROM request_recs GROUP BY basket_id) a USING (basket_id)""",
    ),
    "order_baskets": sql(
        "pairs_of_order",
        f"""SELECT order_id, CAST(count(*) AS INT) AS n_items, {text("list(item_id ORDER BY item_id)")} AS items
  FROM pairs_of_order GROUP BY order_id""",
    ),
    "frequent_itemsets": sql(
        "itemsets", f"SELECT {text('items')} AS items, CAST(len(items) AS INT) AS items_count, freq FROM itemsets"
    ),
    "largest_itemsets": sql(
        "itemsets",
        f"""SELECT {text('items')} AS items, CAST(len(items) AS INT) AS items_count, freq FROM itemsets
 ORDER BY len(itemsets.items) DESC, freq DESC, itemsets.items LIMIT 20""",
    ),
    "association_rules": sql(
        "rules itemsets n_orders",
        f"""SELECT {text('r.antecedent')} AS antecedent, r.consequent, round(r.freq / a.freq, 6) AS confidence,
       round((r.freq / a.freq) / (c.freq / n), 6) AS lift, round(r.freq / n, 6) AS support
  FROM rules r JOIN itemsets a ON a.items = r.antecedent
  JOIN itemsets c ON c.items = [r.consequent], n_orders
 WHERE r.freq / a.freq >= 1e-4""",
    ),
    "null_profile": """SELECT sum(CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END)::BIGINT AS o_orderkey,
       sum(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END)::BIGINT AS o_custkey,
       sum(CASE WHEN o_orderdate IS NULL THEN 1 ELSE 0 END)::BIGINT AS o_orderdate,
       sum(CASE WHEN l_partkey IS NULL THEN 1 ELSE 0 END)::BIGINT AS l_partkey,
       sum(CASE WHEN l_quantity IS NULL THEN 1 ELSE 0 END)::BIGINT AS l_quantity
  FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
    "distinct_profile": """SELECT count(DISTINCT l_partkey) AS distinct_item_id, count(DISTINCT p_brand) AS distinct_item_brand
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey""",
    "measure_percentiles": """SELECT event_type, count(value) AS n_values, round(avg(value), 6) AS mean,
       round(1000 / avg(value), 6) AS per_second, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99
  FROM events GROUP BY event_type""",
    "run_metrics_long": sql(
        "monthly",
        """SELECT run_id, CAST(1 AS INT) AS step, name, round(value, 6) AS value FROM (
  SELECT run_id, 'rmse' AS name, raw AS value FROM monthly
  UNION ALL SELECT run_id, 'n_pairs', CAST(n_pairs AS DOUBLE) FROM monthly
  UNION ALL SELECT run_id, 'log_count', ln(n_pairs + 1) FROM monthly) m""",
    ),
    "learning_curve": sql(
        "curve",
        """SELECT 'gradient' AS run_id, CAST(epoch AS INT) AS epoch, round(train_loss, 6) AS train_loss,
       round(test_loss, 6) AS test_loss, round(sqrt(train_loss), 6) AS train_rmse, round(sqrt(test_loss), 6) AS test_rmse,
       rate AS learning_rate,
       coalesce(sqrt(test_loss) < min(sqrt(test_loss)) OVER (ORDER BY epoch
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS is_best FROM curve""",
    ),
    "als_ratings_rmse": sql(
        "test als_users als_items mean",
        f"""SELECT round(sqrt(avg(({SCORE} - rating) * ({SCORE} - rating))), 6) AS rmse, count(*) AS n_pairs
  FROM test JOIN als_users u USING (user_id) JOIN als_items i USING (item_id), mean""",
    ),
    "als_topk": sql(
        "als_scored", f"SELECT user_id, rank, item_id, round(score, 2) AS score FROM ({ranked_scores('als_scored')}) b"
    ),
    "champion_runs": sql(
        "monthly",
        """SELECT run_id, rmse, n_pairs, is_best,
       last_value(CASE WHEN is_best THEN run_id END IGNORE NULLS) OVER (ORDER BY run_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS champion
  FROM (SELECT *, coalesce(rmse < min(rmse) OVER (ORDER BY run_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS is_best FROM monthly) j""",
    ),
}

# What sinks give back.
ORACLE["split_written"] = sql(
    "interactions cut",
    """SELECT date_partition, CASE WHEN date_partition < (SELECT first_test FROM cut) THEN 'train' ELSE 'test' END AS side,
       count(*) AS n_rows FROM interactions GROUP BY date_partition""",
)
ORACLE["metrics_log"] = ORACLE["run_metrics_long"]
ORACLE["evaluation_saved"] = (
    f"SELECT e.*, '{LAST_YEAR.end_date}' AS eval_date, CAST(1.5 AS DOUBLE) AS training_rmse FROM ({ORACLE['evaluation_summary']}) e"
)
ORACLE["served_champion"] = ORACLE["request_recommendations"]
ORACLE["predict_blocks_test"] = ORACLE["predict_pairs_test"]
ORACLE["stream_follows_champion"] = f"SELECT * FROM ({ORACLE['request_recommendations']}) r WHERE basket_id % 2 = 1"
