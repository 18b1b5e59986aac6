"""The batch run, stage by stage: stores, prices, products, catalogue, vectors.

Tables live under one root as versioned Parquet. Each stage reads the newest version, merges
the export and writes the next one, so a stage can be run again at any time.
"""

import warnings
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder import vocab
from larder.functions import product as P
from larder.functions import variants as V
from larder.functions.text import is_blank
from larder.operators import concepts as C
from larder.operators import labels as L
from larder.operators import merge as M
from larder.operators import prices as R
from larder.operators import reports, vectors
from larder.plans import catalogue, documents
from larder.session import written
from larder.sources import files

CONCEPTS = "store_id bigint, curated_concepts array<string>"


@dataclass
class Run:
    """Where tables live and what a run is given."""

    spark: SparkSession
    root: str
    image_base: str = "https://img.example/catalog"
    piece_image_base: str = "https://img.example"
    department_field: str = "suppliers_department"
    model: str = "rules"
    diet_source: str = "model"
    max_delete_ratio: float | None = None
    max_failed: float | None = L.MAX_FAILED
    now: object = field(default_factory=F.current_timestamp)

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def load(self, name: str) -> DataFrame | None:
        return files.load_table(self.spark, self.table(name))

    def labels(self, name: str) -> DataFrame:
        """Labels of one field that are settled so far; each field is a table of its own."""
        found = self.load(f"labels/{name}")
        return self.spark.createDataFrame([], L.LABEL_SCHEMA) if found is None else found


def _merge(run: Run, name: str, batch: DataFrame, keys: list[str], status=None) -> dict:
    """Merge a written batch into a table: one join, counted while it is written.

    The new version is staged, what it would remove is checked by those counts, and only then is it published.
    """
    old = run.load(name)
    if old is None:
        old = run.spark.createDataFrame([], batch.schema)
    merged = M.merge_export(old, batch, keys, run.now, status)
    kinds = {"upserted": "upserted", "modified": "modified", "soft_deleted": "removed"}
    if not status:
        kinds.pop("soft_deleted")
    metrics = [M.counted(kind).alias(c) for c, kind in kinds.items()]
    # Last step before the write, so a task that is run again is not counted twice.
    counts = Observation(f"merge {name}")
    observed = merged.observe(counts, *metrics, *([M.active_before(status).alias("active")] if status else []))
    number = files.stage_version(observed.drop("change"), run.table(name))
    found = dict(counts.get)
    active = found.pop("active", 0)
    if status and run.max_delete_ratio is not None:
        M.check_removals(found["soft_deleted"], active, run.max_delete_ratio)
    files.publish(run.spark, run.table(name), number)
    return found


def ingest_stores(run: Run, lines: DataFrame, concepts_csv: str | None = None) -> dict:
    """Stores of an export, with curated concepts from the wide CSV if there is one."""
    read, places = Observation("store lines"), Observation("store places")
    lines = lines.observe(read, F.count(F.lit(1)).alias("total"))
    records = documents.parsed(documents.keyed_lines(lines, "store_id"))
    outside = P.geo_out_of_bounds(V.text(F.col("record"), "$.longitude"), V.text(F.col("record"), "$.latitude"))
    records = records.observe(places, F.count_if(outside).alias("out_of_bounds"))
    wide = files.read_wide_csv(run.spark, concepts_csv) if concepts_csv else None
    if wide is None:
        sets = run.spark.createDataFrame([], CONCEPTS)
    else:
        names = [c for c in wide.columns if c != "position"]
        sets = C.concept_sets(C.carried_concepts(wide, names[0], names[2], names[3:]))
    batch = written(documents.store_documents(records, sets, run.now), "stores")
    counts = _merge(run, "stores", batch, ["store_id"], ("is_active", False))
    return {"total": read.get["total"], "out_of_bounds": places.get["out_of_bounds"], **counts}


def ingest_prices(run: Run, lines: DataFrame) -> dict:
    """Price rows of an export; the last price of a product and store counts."""
    read, counters = Observation("price lines"), Observation("prices")
    records = R.read_price_records(lines.observe(read, F.count(F.lit(1)).alias("total")))
    records = records.observe(counters, *R.price_metrics())
    rows = R.flatten_prices(records)
    batch = written(
        M.last_by_key(rows, ["product_id", "store_id"], "position").drop("position"), "prices"
    )
    found = R.with_skipped(counters.get) | read.get
    return {**found, **_merge(run, "prices", batch, ["product_id", "store_id"])}


def label_products(
    run: Run,
    records: DataFrame,
    specs: dict[str, L.Label],
    call: Callable[[str], str],
    force: bool = False,
) -> DataFrame:
    """Labels of all records; steps first, since dish and drink roles depend on them.

    Each field is saved as soon as it is done: a run that ends in a later pass repeats no call of an earlier one.
    """
    # Names are cleaned and lines are made once, not once per label.
    items = written(documents.label_items(records, run.department_field), "items")
    diets = written(documents.diet_items(records), "diet-items")

    def settled(name: str, rows: DataFrame) -> DataFrame:
        cache = run.labels(name)
        found = L.enrich(rows, specs[name], call, cache, run.model, force, max_failed=run.max_failed)
        fresh = written(found, f"labels-{name}")
        files.save_version(M.upsert(cache, fresh.drop("overridden"), ["product_id", "field"]), run.table(f"labels/{name}"))
        return fresh

    steps = settled("menu_step", items)
    stepped = items.join(
        steps.select("product_id", F.col("value").alias("menu_step")), "product_id", "left"
    )
    found = [steps, *(settled(name, stepped) for name in ("dish_role", "could_fit_event", "drink_role"))]
    return files.union_all([*found, settled("predicted_diet", diets)])


def ingest_products(
    run: Run,
    lines: DataFrame,
    price_lines: DataFrame,
    specs: dict[str, L.Label],
    call: Callable[[str], str],
    force: bool = False,
) -> dict:
    """Products of an export with labels and reference prices.

    Products that cannot be recommended are not stored, hence go inactive if they were. Products without a step give a warning.
    """
    read = Observation("product lines")
    lines = lines.observe(read, F.count_if(~is_blank(F.col("value"))).alias("total"))
    records = documents.parsed(
        written(documents.keyed_lines(lines, "product_id"), "product-lines")
    )
    labels = label_products(run, records, specs, call, force)
    prices = R.latest_reference_prices(R.read_price_records(price_lines))
    shaped = documents.product_documents(
        records, prices, L.pivot_labels(labels, run.diet_source), run.now,
        run.image_base, run.piece_image_base, run.department_field,
    )
    batch = written(shaped.where("recommendable"), "products")
    counts = _merge(run, "products", batch, ["product_id"], ("status", "inactive"))
    # A few rows: one per step, field, and label of a field.
    steps = {r["label"]: r["n"] for r in reports.label_distribution(batch, F.col("menu_step")).collect()}
    if steps.get(vocab.UNCLASSIFIED):
        warnings.warn(f"{steps[vocab.UNCLASSIFIED]} products without a step", stacklevel=2)
    fields = {r["field"]: {c: r[c] for c in ("n", "fallback", "overridden")} for r in reports.label_counts(labels).collect()}
    for r in reports.field_distributions(labels).collect():
        fields[r["field"]].setdefault("labels", {})[r["label"]] = r["n"]
    return {"total": read.get["total"], **counts, "steps": steps, "labels": fields}


def build_catalogue(run: Run) -> dict:
    """Summaries of all stores from today's price and product tables."""
    stores = run.load("stores")
    summary = written(
        catalogue.build_store_catalogue(run.load("prices"), run.load("products")), "catalogue"
    )
    counts = catalogue.catalogue_counts(stores, summary).first().asDict()
    files.save_version(catalogue.apply_catalogue(stores, summary), run.table("stores"))
    return counts


def build_vectors(run: Run, embedder: Callable, reset: bool = False, client: vectors.Client | None = None) -> dict:
    """Vector table of the embeddable products; ``reset`` starts from an empty one. ``client`` also takes them to a remote index."""
    products = run.load("products")
    found = vectors.embed(products, embedder)
    batch = vectors.vector_records(found)
    old = None if reset else run.load("vectors")
    files.save_version(batch if old is None else M.upsert(old, batch, ["id"]), run.table("vectors"))
    counts = vectors.embed_counts(products, found).first().asDict()
    return counts if client is None else {**counts, "sent": vectors.send_vectors(batch, client)}


# --- maintenance ----------------------------------------------------------------------


def report_gaps(run: Run, path: str) -> dict:
    """Write the products without a portion count, one folder per step; counts per step."""
    gaps = reports.missing_portions(run.load("products"))
    reports.write_gap_report(gaps, path)
    ranked = reports.gap_summary(gaps).orderBy("position")
    return {r["step"]: r["n"] for r in ranked.collect()}


def drop_retired_fields(
    run: Run, fields: tuple[str, ...] = vocab.RETIRED_FIELDS, apply: bool = False
) -> dict:
    """Count the rows that hold each retired field; drop the fields only if ``apply`` is set."""
    products = run.load("products")
    present = reports.field_presence(products, fields).collect()
    touched = reports.any_field(products, fields).count()
    found = {"fields": {r["field"]: r["n"] for r in present}, "total": present[0]["total"] if present else 0, "rows": touched}
    if not apply:
        return found
    if touched:
        files.save_version(M.drop_fields(products, fields), run.table("products"))
    return {**found, "left": reports.any_field(run.load("products"), fields).count()}


def repair_steps(
    run: Run,
    label: L.Label,
    call: Callable[[str], str],
    stale: tuple[str, ...] = vocab.STALE_STEPS,
    apply: bool = False,
) -> dict:
    """Ask again for products under a retired step, stored ones that left the export too."""
    products = run.load("products")
    counts = {r["step"]: r["n"] for r in reports.stale_steps(products, stale).collect()}
    if not apply or not counts:
        return {"stale": counts}
    old = documents.parsed(products.where(F.col("menu_step").isin(*stale)))
    items = documents.label_items(old, run.department_field)
    none = run.spark.createDataFrame([], L.LABEL_SCHEMA)
    found = L.enrich(items, label, call, none, run.model, force=True, max_failed=run.max_failed)
    fresh = written(found.drop("overridden"), "repaired")
    name = f"labels/{label.field}"
    files.save_version(M.upsert(run.labels(label.field), fresh, ["product_id", "field"]), run.table(name))
    steps = fresh.select("product_id", F.col("value").alias("menu_step"))
    files.save_version(M.update_matched(products, steps, ["product_id"]), run.table("products"))
    now = reports.label_distribution(steps, F.col("menu_step"))
    return {"stale": counts, "now": {r["label"]: r["n"] for r in now.collect()}}
