"""Dimension enrichment.

The fact is joined, inner, with customer (on customer_id), store (store_id =
store.id) and sales team (sales_person_id = sales_team.id). Unmatched fact
rows drop out, NULL keys never match. Output columns have unique names; the
fact's product_name, price, quantity and additional_column and the unused
dimension attributes are pruned (Catalyst pushes that into the scans).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillroll.operators.sizing import broadcast_small, load_profile, raise_on_duplicates, small_sides
from tillroll.schemas import SALE

# The enriched rows' columns.
ENRICHED_COLUMNS = [
    "customer_id", "store_id", "sales_person_id", "sales_date", "total_cost",
    "first_name", "last_name", "address", "pincode", "phone_number",
    "store_address", "store_manager_name",
    "sales_person_first_name", "sales_person_last_name", "manager_id", "is_manager",
    "sales_person_address", "sales_person_pincode",
]


def _customer_side(customer: DataFrame) -> DataFrame:
    return customer.select("customer_id", "first_name", "last_name", "address", "pincode",
                           "phone_number").alias("ct")


def _store_side(store: DataFrame) -> DataFrame:
    return store.select(F.col("id").alias("store_key"), F.col("address").alias("store_address"),
                        "store_manager_name").alias("sto")


def _team_side(sales_team: DataFrame) -> DataFrame:
    return sales_team.select(
        F.col("id").alias("seller_key"),
        F.col("first_name").alias("sales_person_first_name"),
        F.col("last_name").alias("sales_person_last_name"),
        "manager_id", "is_manager",
        F.col("address").alias("sales_person_address"),
        F.col("pincode").alias("sales_person_pincode")).alias("st")


def _maybe_broadcast(side: DataFrame, small: bool | None) -> DataFrame:
    if small is None:                      # decide here, with a bounded count
        return broadcast_small([side])[0]
    return F.broadcast(side) if small else side


def join_customer(sale: DataFrame, customer: DataFrame, small: bool | None = None) -> DataFrame:
    """Fact ⋈ customer on customer_id. ``small`` is the caller's proven
    size decision; ``None`` checks the side here."""
    c = _maybe_broadcast(_customer_side(customer), small)
    return sale.alias("s").join(c, F.col("s.customer_id") == F.col("ct.customer_id"), "inner")


def join_store(sale: DataFrame, store: DataFrame, small: bool | None = None) -> DataFrame:
    """Fact ⋈ store on store_id = store.id."""
    s = _maybe_broadcast(_store_side(store), small)
    return sale.join(s, sale["store_id"] == s["store_key"], "inner").drop("store_key")


def join_sales_team(sale: DataFrame, sales_team: DataFrame, small: bool | None = None) -> DataFrame:
    """Fact ⋈ sales_team on sales_person_id = sales_team.id (the seller's
    store is not checked against the sale's store, as in the original)."""
    t = _maybe_broadcast(_team_side(sales_team), small)
    return sale.join(t, sale["sales_person_id"] == t["seller_key"], "inner").drop("seller_key")


class JoinCounts:
    """How many sales each join loses (no partner, or a NULL key): counted by
    observed metrics in the pass that computes the enriched rows, without a
    scan of its own."""

    STEPS = ("sales", "customer", "store", "sales_team")

    def __init__(self) -> None:
        self._seen = {step: Observation() for step in self.STEPS}

    def watch(self, df: DataFrame, step: str) -> DataFrame:
        return df.observe(self._seen[step], F.count(F.lit(1)).alias("n"))

    def result(self, enriched: DataFrame | None) -> dict[str, int] | None:
        """Counts of the pass that wrote ``enriched`` (None: there was no
        sale). Without an enriched row Spark may have dropped a join before
        it ran, and what it would have counted: None then."""
        if enriched is None:
            return _losses([0] * len(self.STEPS))
        if enriched.isEmpty():
            return None
        return _losses([self._seen[step].get["n"] for step in self.STEPS])


def _losses(n: list[int]) -> dict[str, int]:
    steps = JoinCounts.STEPS
    return {"sales": n[0], **{f"lost_{b}": n[i] - n[i + 1] for i, b in enumerate(steps[1:])}, "enriched": n[-1]}


def count_losses(sale: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame) -> dict[str, int]:
    """What the joins lose, by counting after each of them."""
    left, n = sale.select("customer_id", "store_id", "sales_person_id"), []
    for dim, key, dim_key in ((None, None, None), (customer, "customer_id", "customer_id"), (store, "store_id", "id"),
                              (sales_team, "sales_person_id", "id")):
        if dim is not None:
            keys = dim.select(F.col(dim_key).alias("__key"))
            left = left.join(keys, left[key] == keys["__key"], "left_semi")
        n.append(left.count())
    return _losses(n)


def enrich(sale: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame,
           check_keys: bool = True, counts: JoinCounts | None = None, small: dict[str, bool] | None = None) -> DataFrame:
    """The three joins, then one projection with unique names.

    ``check_keys`` refuses dimensions with duplicate keys, which would fan
    out fact rows. Each dimension is broadcast only when its rows and bytes
    are proven to be within the bounds; otherwise the planner shuffles both sides
    on the key (and AQE may still switch to a broadcast from the observed
    shuffle size). Keys and sizes of all three dimensions are checked in one
    Spark job, once per version of the tables (or, without the key check, in
    one bounded count job). ``small`` is what a caller that has checked keys and
    sizes already found. ``counts`` observes what the joins lose.
    """
    keys = {"customer": "customer_id", "store": "id", "sales_team": "id"}
    frames = {"customer": customer, "store": store, "sales_team": sales_team}
    if small is None and check_keys:
        profile = load_profile({n: (frames[n], keys[n]) for n in keys})
        raise_on_duplicates(profile, keys)
        small = small_sides(profile, sale)
    elif small is None:
        hinted = broadcast_small([frames[n] for n in keys])
        small = {n: h is not frames[n] for n, h in zip(keys, hinted)}
    return _joined(sale, customer, store, sales_team, small, counts.watch if counts else lambda df, step: df)


def _joined(sale: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame, small: dict[str, bool], watch) -> DataFrame:
    fact = watch(sale.select("customer_id", "store_id", "sales_person_id", "sales_date", "total_cost"), "sales")
    j1 = watch(join_customer(fact, customer, small["customer"]), "customer").select(
        F.col("s.customer_id").alias("customer_id"), "store_id", "sales_person_id", "sales_date",
        "total_cost", "first_name", "last_name", "address", "pincode", "phone_number")
    j2 = watch(join_store(j1, store, small["store"]), "store")
    j3 = watch(join_sales_team(j2, sales_team, small["sales_team"]), "sales_team")
    return j3.select(*ENRICHED_COLUMNS)


def enriched_schema(customer: DataFrame, store: DataFrame, sales_team: DataFrame):
    """Schema of the enriched rows; nothing is read."""
    no_sale = customer.sparkSession.createDataFrame([], SALE)
    return _joined(no_sale, customer, store, sales_team, dict.fromkeys(("customer", "store", "sales_team"), False), lambda df, step: df).schema
