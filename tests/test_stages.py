"""The whole run on a small export, twice."""

import json
import sys

import pytest
from pyspark import cloudpickle

from larder import vocab
from larder.operators import labels as L
from larder.plans import rules, stages
from larder.sources import files

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PRODUCTS = [
    {"product_id": 1, "sku": "1", "name": "12 mini ring (bio)", "status": "Activé", "nb_portion": "4", "weight": "750.0000", "extra": {"a": [1]}},
    {"product_id": "2", "sku": "2", "name": "Plate de red bolt - 75cl", "status": "Activé", "nb_portion": None, "type_envie": ["Sans Porc", "x"]},
    {"product_id": 3, "sku": "3", "name": "small plate", "status": "Activé", "nb_portion": 2, "ingredients": "&lt;b&gt;riz&lt;/b&gt;"},
    {"product_id": 4, "name": "bolt au choix", "status": "Activé"},
    {"product_id": 5, "name": "hot bolt", "status": "Désactivé", "weight": "330.0"},
    {"product_id": 6, "name": "hot bolt sans alcool", "status": "Activé", "weight": "330.0"},
    {"product_id": 7, "name": "Anvil", "status": "Activé"},
    {"product_id": 3, "sku": "3b", "name": "small plate", "status": "Activé", "nb_portion": 2},
]
PRICES = [
    {"product_id": 1, "stores": [{"store_id": 10, "prices": [{"price": "10"}]}, {"store_id": 11, "price": {"price": 20.0}}]},
    {"product_id": 2, "stores": [{"store_id": 10, "prices": [{"price": 4}, {"price": 5}]}]},
    {"product_id": 3, "stores": [{"store_id": 10, "price": {"price": 8}}, {"store_id": 12}]},
    {"product_id": 6, "stores": [{"store_id": 10, "price": {"price": "3.5"}}]},
    {"product_id": 7, "stores": [{"store_id": 13, "price": {"price": "3.5"}}]},
]
STORES = [
    {"store_id": 10, "name": "A", "is_active": True, "longitude": "2.35", "latitude": 48.85, "concepts": ["x", 1]},
    {"store_id": 11, "name": "B", "is_active": True, "longitude": "200", "latitude": "1"},
    {"store_id": 12, "name": "C", "is_active": True, "lad_postcodes": None},
    {"store_id": 13, "name": "D", "is_active": None},
    {"store_id": 14, "name": "E"},
]
CONCEPTS = "id,x,Statut,Pain,Vin\n10,,Activé,1,1\n11,,Désactivé,1,1\n"

SPECS = {
    "menu_step": L.menu_step("STEPS"), "dish_role": L.dish_role("ROLES"), "drink_role": L.drink_role("DRINKS"),
    "could_fit_event": L.event_fit("EVENTS"), "predicted_diet": L.predicted_diet("DIETS"),
}


def answer(prompt):
    kinds = {"STEPS": rules.steps, "ROLES": rules.roles, "DRINKS": rules.drinks, "EVENTS": rules.events, "DIETS": rules.diets}
    return kinds[prompt.split("\n")[0]](prompt)


def write(folder, name, rows):
    path = folder / name
    path.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows) + "\n\n", encoding="utf-8")
    return str(path)


def test_run(spark, tmp_path):
    def lines(name, rows):
        return files.read_lines(spark, write(tmp_path, name, rows))

    (tmp_path / "c.csv").write_text(CONCEPTS, encoding="utf-8")
    run = stages.Run(spark, str(tmp_path / "tables"), model="m1", diet_source="read")
    price_lines = lines("prices.jsonl", PRICES)

    got = stages.ingest_stores(run, lines("stores.jsonl", STORES), str(tmp_path / "c.csv"))
    assert got == {"total": 6, "out_of_bounds": 1, "upserted": 5, "modified": 0, "soft_deleted": 0}
    got = stages.ingest_prices(run, price_lines)
    # Two prices for one store: two rows, one stored.
    assert got == {"total": 6, "entries": 7, "price_rows": 7, "skipped_no_price": 0, "upserted": 6, "modified": 0}
    with pytest.warns(UserWarning, match="1 products without a step"):
        got = stages.ingest_products(run, lines("products.jsonl", PRODUCTS), price_lines, SPECS, answer)
    fields = got.pop("labels")
    assert got == {
        "total": 8, "upserted": 6, "modified": 0, "soft_deleted": 0,
        "steps": {"Desserts": 1, "Plats": 2, "Boissons": 2, "unclassified": 1},
    }
    # The product that is not stored was asked too; one drink's name overrode the model.
    assert fields["menu_step"] == {"n": 6, "fallback": 0, "overridden": 0, "labels": {"Desserts": 1, "Plats": 2, "Boissons": 3}}
    assert fields["drink_role"]["overridden"] == 1 and sum(fields["drink_role"]["labels"].values()) == 3
    assert {f: x["fallback"] for f, x in fields.items()} == dict.fromkeys(SPECS, 0)
    assert set(fields["could_fit_event"]["labels"]) <= {*vocab.EVENTS, vocab.ALL_EVENTS} and fields["predicted_diet"]["labels"]

    docs = {r.product_id: r for r in run.load("products").collect()}
    assert sorted(docs) == [1, 2, 3, 5, 6, 7]
    one, two, three, six = docs[1], docs[2], docs[3], docs[6]
    assert (one.menu_step, one.persons, one.volume_ml, one.price_ref, one.family) == ("Desserts", 4, None, 15.0, "ring")
    assert one.could_fit_event == ["Anniversaire", "Mariage"]
    assert json.loads(one.raw)["extra"] == {"a": [1]}
    assert (two.menu_step, two.dish_role, two.dietary_tags, two.price_ref) == ("Plats", "main", ["sans porc"], 4.5)
    assert (three.sku, three.dish_role, three.predicted_diet.profile, three.predicted_diet.source) == ("3b", "side", "vegetarien", "read")
    assert (six.drink_role, six.volume_ml, docs[5].drink_role, docs[5].status) == ("sans_alcool", 330, "chaud", "inactive")
    assert docs[7].menu_step is None and docs[7].could_fit_event == ["ALL"]

    assert stages.build_catalogue(run) == {"stores_updated": 2, "empty_catalogue": 1}
    stores = {r.store_id: r for r in run.load("stores").collect()}
    ten = stores[10]
    assert ten.step_catalogue == {"Boissons": 1, "Desserts": 1, "Plats": 2}
    assert ten.step_families == {"Boissons": ["hot"], "Desserts": ["ring"], "Plats": ["plate", "small"]}
    # The side dish sets no price for its step; the main has no portions.
    assert ten.step_typical_cost == {"Desserts": 2.5}
    assert (ten.geo.coordinates, ten.curated_concepts, ten.concepts) == ([2.35, 48.85], ["Pain", "Vin"], ["x", "1"])
    assert stores[11].step_catalogue == {"Desserts": 1} and stores[11].geo is None
    assert stores[12].step_catalogue == {} and stores[12].lad_postcodes is None
    assert stores[13].step_catalogue is None and stores[13].is_active is None
    assert stores[14].is_active is False and stores[14].lad_postcodes == []

    sent = tmp_path / "sent"
    sent.mkdir()
    folder = str(sent)

    def client():
        def send(batch):
            import uuid

            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(r["id"] for r in batch))

        return send

    got = stages.build_vectors(run, rules.embedder, client=client)
    assert got == {"eligible": 4, "blank_name": 0, "failed": 0, "sent": 4}
    assert sorted(x for p in sent.iterdir() for x in p.read_text().split("\n")) == ["1", "2", "3", "6"]
    assert {r.id for r in run.load("vectors").collect()} == {"1", "2", "3", "6"}

    # Second export: product 1 gone, 3 kept; labels come from the cache, the model is not asked.
    def never(prompt):
        raise AssertionError("asked again")

    again = [p for p in PRODUCTS if p["product_id"] in ("2", 3)]
    got = stages.ingest_products(run, lines("products2.jsonl", again), price_lines, SPECS, never)
    assert (got["upserted"], got["soft_deleted"]) == (0, 3)
    docs = {r.product_id: r for r in run.load("products").collect()}
    assert sorted(docs) == [1, 2, 3, 5, 6, 7]
    assert docs[1].status == "inactive" and docs[1].removed_at is not None and docs[1].menu_step == "Desserts"
    assert docs[3].removed_at is None and docs[3].menu_step == "Plats" and docs[3].dish_role == "side"
    got = stages.ingest_prices(run, price_lines)
    assert (got["upserted"], got["modified"]) == (0, 0)

    # Nothing sold any more at store 11: yesterday's summary must go.
    assert stages.build_catalogue(run) == {"stores_updated": 1, "empty_catalogue": 2}
    stores = {r.store_id: r for r in run.load("stores").collect()}
    assert stores[11].step_catalogue == {} and stores[10].step_catalogue == {"Plats": 2}
    assert stages.build_vectors(run, rules.embedder, reset=True)["eligible"] == 2
    assert {r.id for r in run.load("vectors").collect()} == {"2", "3"}


def test_a_crash_in_the_last_pass_repeats_that_pass_only(spark, tmp_path):
    log = tmp_path / "asked"
    log.mkdir()
    folder = str(log)

    def counted(prompt):
        import uuid

        kind = prompt.split("\n")[0]
        with open(f"{folder}/{kind}-{uuid.uuid4().hex}", "w"):
            pass
        return answer(prompt)

    def broken(prompt):
        if prompt.startswith("DIETS"):
            raise OSError("down")
        return counted(prompt)

    lines = files.read_lines(spark, write(tmp_path, "p.jsonl", PRODUCTS))
    records = stages.documents.parsed(stages.documents.keyed_lines(lines, "product_id"))
    run = stages.Run(spark, str(tmp_path / "t"))
    with pytest.raises(RuntimeError, match="model calls failed"):
        stages.label_products(run, records, SPECS, broken)
    assert sorted({p.name.split("-")[0] for p in log.iterdir()}) == ["DRINKS", "EVENTS", "ROLES", "STEPS"]
    before = {p.name for p in log.iterdir()}
    found = stages.label_products(run, records, SPECS, counted)
    again = {p.name.split("-")[0] for p in log.iterdir() if p.name not in before}
    # Items that a good reply left out are asked again; a step that is known is not.
    assert "DIETS" in again and "ROLES" not in again and "DRINKS" not in again
    assert {r.field for r in found.select("field").distinct().collect()} == set(SPECS)


def test_a_lost_export_publishes_nothing(spark, tmp_path):
    run = stages.Run(spark, str(tmp_path / "t"), max_delete_ratio=0.5)
    stages.ingest_stores(run, files.read_lines(spark, write(tmp_path, "s.jsonl", STORES)))
    with pytest.raises(ValueError, match="would be removed"):
        stages.ingest_stores(run, files.read_lines(spark, write(tmp_path, "none.jsonl", STORES[:0])))
    assert run.load("stores").where("is_active").count() == 3


def test_labels_in_the_table_are_known_ones(spark, tmp_path):
    lines = files.read_lines(spark, write(tmp_path, "p.jsonl", PRODUCTS))
    records = stages.documents.parsed(stages.documents.keyed_lines(lines, "product_id"))
    run = stages.Run(spark, str(tmp_path / "t"))
    found = stages.label_products(run, records, SPECS, answer)
    for r in found.collect():
        if r.field == "menu_step":
            assert r.value in vocab.STEPS
        if r.field == "drink_role":
            assert r.value in vocab.DRINK_ROLES


def test_maintenance(spark, tmp_path):
    run = stages.Run(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame(
        [
            (1, "1", "active", "Plateaux", None, '{"name":"ring"}', "x"),
            (2, "2", "inactive", "À côté", None, '{"name":"plate"}', None),
            (3, "3", "active", "Pains", None, '{"name":"rod"}', None),
            (4, "4", "active", "Pains", 2, '{"name":"rod"}', None),
        ],
        "product_id long, sku string, status string, menu_step string, persons int, raw string, is_food string",
    )
    files.save_version(rows, run.table("products"))
    assert stages.report_gaps(run, str(tmp_path / "gaps")) == {"Pains": 1, "Plateaux": 1}
    dry = stages.drop_retired_fields(run)
    assert (dry["rows"], dry["total"], dry["fields"]["is_food"], "is_food" in run.load("products").columns) == (1, 4, 1, True)
    assert stages.drop_retired_fields(run, apply=True)["left"] == 0
    assert "is_food" not in run.load("products").columns
    assert stages.repair_steps(run, SPECS["menu_step"], answer) == {"stale": {"Plateaux": 1, "À côté": 1}}
    done = stages.repair_steps(run, SPECS["menu_step"], answer, apply=True)
    assert done["now"] == {"Desserts": 1, "Plats": 1}
    steps = {r.product_id: r.menu_step for r in run.load("products").collect()}
    assert steps == {1: "Desserts", 2: "Plats", 3: "Pains", 4: "Pains"}


def test_line_without_key_ends_the_job(spark, tmp_path):
    for bad in ('{"sku":"1"}', "{oops"):
        (tmp_path / "bad.jsonl").write_text('{"product_id":1}\n' + bad + "\n")
        lines = files.read_lines(spark, str(tmp_path / "bad.jsonl"))
        try:
            stages.documents.keyed_lines(lines, "product_id").collect()
        except Exception as e:
            assert "no product_id in line" in str(e)
        else:
            raise AssertionError
