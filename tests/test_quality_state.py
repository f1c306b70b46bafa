"""The stored check state: after random inserts, heals and deletions it gives what a full run gives, from the changes alone."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martlens import schemas
from martlens.operators import quality, quality_state
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.sources import versions
from martlens.testing import micro_tables

P = Params.fixture()
DAY = dt.date(2001, 7, 1)
MAIL = ["a@x.com", "b@x.com", "b@x.com", "no mail", None]


def customer(rng, k):
    return (k, rng.choice(MAIL), "A", "B", DAY, "IN", None)


def product(rng, k):
    return (k, f"p{k}", "C", "s", rng.choice([2, 9]), 5, DAY, True)


def order(rng, k, customers):
    return (k, rng.choice([*customers, 77, None]), rng.choice([DAY, dt.date(2003, 1, 1), None]), "Paid", "UPI", "IN", 1, rng.choice([None, Decimal("10.00"), Decimal("20.00")]))


def item(rng, k, order_id, products):
    return (k, order_id, rng.choice([*products, 66, None]), rng.choice([1, 2, 0]), rng.choice([10, -1]), rng.choice([None, 0, 130]))


def review(rng, k, products, customers):
    return (k, rng.choice([*products, 66]), rng.choice([*customers, 77, None]), rng.choice([1, 5, 9]), "t", rng.choice([DAY, None]), rng.choice([True, True, False, None]))


class World:
    """Tables as lists of rows, which random steps change."""

    def __init__(self, seed):
        self.rng, self.next = random.Random(seed), 100
        rng = self.rng
        self.t = {"customers": [customer(rng, k) for k in range(8)], "products": [product(rng, k) for k in range(6)],
                  "orders": [], "order_items": [], "customer_reviews": [], "promotions": [], "promotion_usage": [], "inventory": []}
        for k in range(12):
            self.add_order()
        ids = [[r[0] for r in self.t[n]] for n in ("products", "customers")]
        self.t["customer_reviews"] = [review(rng, k, *ids) for k in range(10)]
        self.t["inventory"] = [self.stock(k) for k in (0, 1, 1, 2, 9)]
        self.t["promotions"] = [self.promotion(k) for k in range(3)]
        self.t["promotion_usage"] = [(k, rng.choice([0, 1, 5, None]), 100, True, DAY) for k in range(5)]

    def stock(self, product_id):
        self.next += 1
        return self.row("inventory", inventory_id=self.next, product_id=product_id, stock_quantity=self.rng.choice([-5, 3, None]))

    def promotion(self, k):
        return self.row("promotions", promotion_id=k, max_uses=5, times_used=self.rng.choice([1, 9]))

    @staticmethod
    def row(table, **values):
        return tuple(values.get(f.name) for f in schemas.TABLES[table].fields)

    def add_order(self):
        self.next += 1
        self.t["orders"].append(order(self.rng, self.next, [r[0] for r in self.t["customers"]]))
        for _ in range(self.rng.choice([0, 1, 2, 3])):
            self.next += 1
            self.t["order_items"].append(item(self.rng, self.next, self.rng.choice([self.t["orders"][-1][0]] * 9 + [None]), [r[0] for r in self.t["products"]]))

    def step(self):
        """Some inserts, changes and deletions everywhere."""
        rng = self.rng
        for _ in range(3):
            self.add_order()
        for table, make in (("customers", lambda k: customer(rng, k)), ("products", lambda k: product(rng, k)),
                            ("customer_reviews", lambda k: review(rng, k, [r[0] for r in self.t["products"]], [r[0] for r in self.t["customers"]])),
                            ("inventory", lambda k: self.stock(rng.choice([0, 3, 4]))), ("promotions", self.promotion),
                            ("promotion_usage", lambda k: (k, rng.choice([0, 2, 7]), 100, True, DAY)),
                            ("orders", lambda k: order(rng, k, [r[0] for r in self.t["customers"]])),
                            ("order_items", lambda k: item(rng, k, rng.choice([r[0] for r in self.t["orders"]]), [r[0] for r in self.t["products"]]))):
            rows = self.t[table]
            rows.pop(rng.randrange(len(rows)))
            at = rng.randrange(len(rows))
            rows[at] = make(rows[at][0])
            self.next += 1
            rows.append(make(self.next))

    def copy(self):
        return {n: list(rows) for n, rows in self.t.items()}


def changes_of(spark, old, new):
    """Changed rows; of orders and items, all rows of the orders that changed in any way."""
    before, after = {}, {}
    moved = set()
    for name, place in (("orders", 0), ("order_items", 1)):
        a, b = Counter(old[name]), Counter(new[name])
        moved |= {r[place] for r in (a - b) + (b - a)}
    for name in new:
        if name in ("orders", "order_items"):
            place = 0 if name == "orders" else 1
            sides = [[r for r in t[name] if r[place] in moved] for t in (old, new)]
        else:
            a, b = Counter(old[name]), Counter(new[name])
            sides = [list((a - b).elements()), list((b - a).elements())]
        for side, rows in zip((before, after), sides):
            if rows:
                side[name] = spark.createDataFrame(rows, schemas.TABLES[name])
    return quality_state.Changes(before, after)


def frames(spark, t):
    return micro_tables(spark, **t)


def summary(df):
    return sorted((r.check_name, r.row_count, r.sample_ids) for r in df.collect())


def whole(spark, t):
    return summary(quality.summarize(frames(spark, t), P, quality.CHECKS))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_changes_equal_the_full_run(spark, seed, tmp_path):
    world, root = World(seed), str(tmp_path / "state")
    old = world.copy()
    first = quality_state.Changes({}, {n: spark.createDataFrame(rows, schemas.TABLES[n]) for n, rows in old.items()})
    assert quality_state.fold_changes(spark, root, first, frames(spark, old), P, "first") == 1
    assert summary(quality_state.issues(quality_state.stored(spark, root)[0], P)) == whole(spark, old)
    for n in range(3):
        world.step()
        new = world.copy()
        changes = changes_of(spark, old, new)
        assert quality_state.fold_changes(spark, root, changes, frames(spark, new), P, f"night {n}") == n + 2
        assert quality_state.fold_changes(spark, root, changes, frames(spark, new), P, f"night {n}") is None
        assert summary(quality_state.issues(quality_state.stored(spark, root)[0], P)) == whole(spark, new), n
        old = new
    # all is taken away again
    empty = {n: [] for n in old}
    quality_state.fold_changes(spark, root, changes_of(spark, old, empty), frames(spark, empty), P, "end")
    assert quality_state.issues(quality_state.stored(spark, root)[0], P).count() == 0
    assert all(df.count() == 0 for df in quality_state.stored(spark, root)[0].values()) and len(versions.committed(spark, root)) == 5


def unreadable(spark, t):
    """Facts that fail as soon as one row is read."""
    broken = {}
    for name in ("orders", "order_items"):
        df = t[name]
        broken[name] = df.select(*[F.raise_error(F.lit(f"{name} was read")).cast(f.dataType).alias(f.name) if k == 0 else F.col(f.name) for k, f in enumerate(df.schema.fields)])
    return t.replace(**broken)


def test_a_night_reads_its_changes_only(spark, tmp_path):
    """New, changed and deleted orders and items, new customers and products: the facts are never opened."""
    world, root = World(5), str(tmp_path / "state")
    old = world.copy()
    quality_state.fold_changes(spark, root, quality_state.Changes({}, {n: spark.createDataFrame(rows, schemas.TABLES[n]) for n, rows in old.items()}), frames(spark, old), P, "first")
    for _ in range(4):
        world.add_order()
    gone = world.t["orders"].pop(0)[0]
    world.t["order_items"] = [r for r in world.t["order_items"] if r[1] != gone]
    changed = world.t["orders"][0]
    world.t["orders"][0] = (*changed[:7], Decimal("99.00"))
    world.t["customers"].append(customer(world.rng, 77))  # lost orders find their customer
    world.t["products"].append(product(world.rng, 66))
    new = world.copy()
    t = frames(spark, new)
    quality_state.fold_changes(spark, root, changes_of(spark, old, new), unreadable(spark, t), P, "night")
    assert summary(quality_state.issues(quality_state.stored(spark, root)[0], P)) == whole(spark, new)
    # a product that is sold is deleted: now its items are looked up
    world.t["products"] = [r for r in world.t["products"] if r[0] != 66]
    last = world.copy()
    with pytest.raises(Exception, match="order_items was read"):
        quality_state.fold_changes(spark, root, changes_of(spark, new, last), unreadable(spark, frames(spark, last)), P, "deletion")
    quality_state.fold_changes(spark, root, changes_of(spark, new, last), frames(spark, last), P, "deletion")
    assert summary(quality_state.issues(quality_state.stored(spark, root)[0], P)) == whole(spark, last)


def test_heals_as_changes(spark, tmp_path):
    """A heal is a change set like any other: totals and lost customers mended."""
    from martlens.operators.cleaning import heal
    world, root = World(8), str(tmp_path / "state")
    old = frames(spark, world.copy())
    quality_state.fold_changes(spark, root, quality_state.Changes({}, {n: old[n] for n in quality_state.CHANGED}), old, P, "first")
    healed, _ = heal(old, P)
    healed = healed.replace(**{n: spark.createDataFrame(healed[n].collect(), schemas.TABLES[n]) for n in ("customers", "orders")})
    both = {n: (old[n].exceptAll(healed[n]), healed[n].exceptAll(old[n])) for n in ("customers", "orders")}
    ids = both["orders"][0].select("order_id").distinct()
    items = old.order_items.join(ids, "order_id", "left_semi").select(old.order_items.columns)
    before = {"customers": both["customers"][0], "orders": both["orders"][0], "order_items": items}
    after = {"customers": both["customers"][1], "orders": both["orders"][1], "order_items": items}
    quality_state.fold_changes(spark, root, quality_state.Changes(before, after), healed, P, "heal")
    assert summary(quality_state.issues(quality_state.stored(spark, root)[0], P)) == summary(quality.summarize(healed, P, quality.CHECKS))


def test_change_sets_of_one_table_and_of_nothing(spark, tmp_path):
    world, root = World(3), str(tmp_path / "state")
    t = frames(spark, world.copy())
    quality_state.fold_changes(spark, root, quality_state.Changes({}, {n: t[n] for n in quality_state.CHANGED}), t, P, "first")
    want = whole(spark, world.copy())
    quality_state.fold_changes(spark, root, quality_state.Changes({}, {}), unreadable(spark, t), P, "nothing")
    assert summary(quality_state.issues(quality_state.stored(spark, root)[0], P)) == want
    assert isinstance(quality_state.Changes({}, {}).side(spark, "after"), RetailTables)


def test_the_incremental_run_derives_the_items_once(spark, tmp_path):
    """All steps read written tables: numbering the order lines, which ranges them, is done once, whatever steps follow."""
    from martlens import plans
    t = plans.tables.RetailTables.from_fixture(spark, "/root/testdata/sf0.001")
    build, times = t._builders["order_items"], []
    numbered = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            numbered.add(b.num_rows)
            yield b
    items = build()
    n = items.count()
    t._builders["order_items"] = lambda: times.append(1) or items.mapInArrow(counted, items.schema)
    got = summary(quality_state.dq_run_incremental(t, P))
    assert numbered.value == n and times == [1]
    assert got == summary(quality.dq_run_all(plans.tables.RetailTables.from_fixture(spark, "/root/testdata/sf0.001"), P))


def test_a_repeated_or_null_order_id_is_parted_as_by_a_semi_join(spark):
    """Items of an id that has a late and an early order go with the late ones; items of no order with the first ones."""
    late, early = dt.date(2001, 7, 3), dt.date(2001, 6, 3)
    t = micro_tables(spark, orders=[(1, 5, late, "s", "p", "IN", 1, None), (1, 5, early, "s", "p", "IN", 1, None), (2, 5, None, "s", "p", "IN", 1, None), (None, 5, late, "s", "p", "IN", 1, None)],
                     order_items=[(1, 1, 7, 1, 1, None), (2, 2, 7, 0, 1, None), (3, None, 7, 1, -1, None), (4, 99, 7, 1, 1, 130)], customer_reviews=[(1, 7, 5, 5, "t", late, True)])
    got = {(r.check_name, r.row_count) for r in quality_state.dq_run_incremental(t, P).collect()}
    assert {("order_items_invalid_product", 4), ("negative_quantity_or_price", 2), ("invalid_discount_percent", 1)} <= got
