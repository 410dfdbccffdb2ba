import numpy as np
import pytest
from pyspark.sql import functions as F

from lumbre.functions import numbers, text
from lumbre.operators import certificates, clustering, features, layout, quantiles, relational, statistics
from lumbre.sources import html, tables


def test_best_match_puts_nulls_first(spark):
    left = spark.createDataFrame([("d1", "R1", "Talca")], "id string, rol string, comuna string")
    right = spark.createDataFrame([(10, "R1", None), (11, "R1", "talca "), (12, "R2", "Talca")], "uid int, r_rol string, r_comuna string")
    order = [*relational.match_order(F.lower(F.trim("r_comuna")) == F.lower(F.trim("comuna"))), F.col("uid")]
    pick = lambda r: relational.best_match(left, r, F.col("rol") == F.col("r_rol"), ["id"], order).first()["uid"]
    assert pick(right) == 10 and pick(right.where("uid <> 10")) == 11 and pick(right.where("uid = 12")) is None


def test_pairs_with_nulls_count(spark):
    df = spark.createDataFrame([("R1", "d"), ("R1", "d"), (None, "d"), (None, None)], "a string, b string")
    assert relational.load_totals(df, ("a", "b"), "b").first()["n_pairs"] == 3


def test_upserts(spark):
    old = spark.createDataFrame([("a", "x", "depto"), ("b", "y", "casa")], "id string, v string, kind string")
    new = spark.createDataFrame([("a", "z")], "id string, v string")
    assert sorted(map(tuple, relational.upsert_replace(old, new, ["id"]).collect()), key=str) == [("a", "z", None), ("b", "y", "casa")]
    kept = spark.createDataFrame([(7, 1, "x"), (9, 2, "y")], "uid long, row int, v string")
    more = spark.createDataFrame([(2, "new"), (5, "five"), (3, "three")], "row int, v string")
    got = sorted(map(tuple, relational.upsert_update(kept, more, "row", "uid", F.col("row")).collect()))
    assert got == [(7, 1, "x"), (9, 2, "new"), (10, 3, "three"), (11, 5, "five")]


def test_resume_matches_title_or_name(spark):
    c = spark.createDataFrame([("r", "t1", "n1"), ("r", "t2", "n2"), ("r", "t3", "n3")], "k string, title string, name string")
    log = spark.createDataFrame([("r", "t1", "zz", "ok"), ("r", "zz", "n2", "ok"), ("r", "t3", "n3", "error")], "k string, title string, name string, estado string")
    assert [x["title"] for x in relational.resume(c, log, ["k"], "title", "name").collect()] == ["t3"]


def test_wrapped_rows(spark):
    rows = spark.createDataFrame([("d", "a", 0.0, 0.0, 10.0, 1), ("d", "b", 0.0, 12.0, 20.0, 1), ("d", "c", 0.0, 30.0, 38.0, 1)], "doc string, text string, x0 double, y0 double, y1 double, n_words int").withColumn("x1", F.lit(1.0))
    assert [r["text"] for r in layout.merge_wrapped(rows, ["doc"]).orderBy("record").collect()] == ["a b", "c"]


def test_page_to_region_rows(spark):
    chars, x = [], 0.0
    for line, words in enumerate(["ab cd", "ef"]):
        x = 0.0
        for c in words:
            chars.append(("d", 1, 1, "l", 1.0, c, x, 20.0 * line, x + 5, 20.0 * line + 10))
            x += 5
    df = spark.createDataFrame(chars, "doc string, page int, seqno int, layer string, opacity double, text string, x0 double, y0 double, x1 double, y1 double")
    shapes = spark.createDataFrame([("d", 1, 2, "fill-path", 14.0, -1.0, 26.0, 11.0)], "doc string, page int, seqno int, kind string, x0 double, y0 double, x1 double, y1 double")
    words = layout.page_words(df, shapes)
    assert sorted(r["text"] for r in words.collect()) == ["ab", "ef"]
    regions = spark.createDataFrame([("r1", 1, -1.0, -1.0, 50.0, 50.0)], "id string, page int, x0 double, y0 double, x1 double, y1 double")
    rows = layout.region_rows(words, regions).orderBy("row_index").collect()
    assert [(r["row_index"], r["text"]) for r in rows] == [(1, "ab"), (2, "ef")]


def test_certificate_tables(spark):
    regions = {
        "page_01_region_01": ["Codigo: c1", "Region: Maule", "Comuna: Talca", "Direccion: x", "Rol: R1", "Tipo: casa", "Sup: 57,2"], "page_01_region_02": ["AHORRO 70% B"], "page_01_region_03": ["demanda 10 20,5"], "page_01_region_05": ["01-02-2020"],
        "page_02_region_01": ["Zona: D", "57", "Sol: s", "Ev: e", "Codigo: abc1"], "page_03_region_01": ["1,5", "2", "x", "4"], "page_03_region_13": ["1", "2"], "page_03_region_16": ["0,5"], "page_03_region_15": ["0,7 -0,3 0,3 0 0"],
    }
    docs = spark.createDataFrame([("x_calificadas_i.pdf", 7, regions), ("old.pdf", 4, regions)], "source_pdf string, n_pages int, regions map<string,array<string>>")
    wrapped = spark.createDataFrame([("x_calificadas_i.pdf", "page_02_region_03", "0,6", 0.0, 0.0, 1.0, 10.0, 1), ("x_calificadas_i.pdf", "page_02_region_03", "[W/m2K]", 0.0, 11.0, 1.0, 20.0, 1)], "source_pdf string, region_id string, text string, x0 double, y0 double, x1 double, y1 double, n_words int")
    out = certificates.build_all(docs, wrapped)
    g = out["descripcion_general"].collect()
    assert len(g) == 1 and g[0]["document_id"] == "abc1" and g[0]["superficie_util"] == 57.2 and (g[0]["ahorro"], g[0]["etiqueta"]) == (70.0, "B") and g[0]["demanda_calef"] == 20.5 and g[0]["estado_cev"] == "calificada"
    assert out["requerimientos"].first()["ilum_kwhm2"] == 2.0 and out["requerimientos"].first()["calef_kwhm2"] is None
    assert out["elementos_opacos"].count() == 10 and out["puentes_termicos"].count() == 1 and out["materialidades"].count() == 10
    assert out["exigencia_u_normativa"].where("elemento = 'muro_principal'").first()["exigencia_u"] == 0.6


PAGE = """<form action='b.aspx'><input name=a value=1><input type=checkbox name=c><input type=checkbox name=k checked><select name=s><option value=x><option value=y selected></select><textarea name=t>hi</textarea>
<table id=g><tr><td>Identificación Vivienda<td>b<td>c<td>d<td>e</tr><tr><td>id1</td><td>Casa</td><td>Talca</td><td>P</td><td class=hidden>no</td><td><input type=image name=n1 title='Ver Informe'></td></tr><tr><td>1</td><td>2</td><td>3</td><td>4</td><td>5</td></tr></table></form>
Viviendas Calificadas Se ha(n) encontrado 1.234 Viviendas"""


def test_pages(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None)], "page_id long, html string")
    rows = html.html_rows(df, "page_id", table_id="g").collect()
    assert [(r["ident"], r["commune"], r["actions"][0]["name"]) for r in rows] == [("id1", "Talca", "n1")]
    assert html.html_form(df, "page_id").where("page_id = 1").first()["payload"] == {"a": "1", "k": "on", "s": "y", "t": "hi"}
    assert [(r["total"], r["pages"]) for r in html.html_totals(df, "page_id", "calificadas").orderBy("page_id").collect()] == [(1234, 124), (0, 0)]
    assert html.form_action(PAGE, "http://h/a.aspx") == "http://h/b.aspx"


def test_planted_clusters(spark):
    rows = clustering.demo_rows(spark)
    out = clustering.hdbscan(rows, "row", ["superficie_util", "calef_proyec_kwh"], ["zona_termica", "tipo_inmueble"], 20, 5)
    groups = out.where("cluster >= 0").groupBy("cluster", (F.col("row") % 3).alias("g")).count().collect()
    assert len(groups) == 3 and sum(r["count"] for r in groups) >= 170
    labelled = rows.withColumn("label", F.col("row") % 3)
    assert clustering.silhouettes(labelled, "row", ["superficie_util"], ["zona_termica"], "label").agg(F.avg("silhouette")).first()[0] > 0.8
    assert clustering.silhouettes(labelled.withColumn("label", F.lit(0)), "row", ["superficie_util"], [], "label").count() == 0
    with pytest.raises(ValueError, match="seeded_sample"):
        clustering.prepare(rows, "row", ["superficie_util"], [], most=10)


def test_tails():
    assert abs(statistics.gamma_tail(0.5, 3.841458820694124 / 2) - 0.05) < 1e-9
    assert abs(statistics.gamma_tail(5, 18.307038053275146 / 2) - 0.05) < 1e-9


def test_percentiles_with_nulls_ties_and_groups(spark):
    rng = np.random.default_rng(2)
    rows = [(None if k % 5 == 0 else f"g{k % 3}", float(rng.integers(0, 40)) if k % 7 else None, float(rng.normal())) for k in range(900)]
    df = spark.createDataFrame([*rows, ("one", 4.0, None)], "g string, x double, y double")
    got = {(r["g"], r["variable"]): r["q"] for r in quantiles.percentiles(df, ["x", "y"], [0.0, 0.01, 0.25, 0.5, 0.99, 1.0], ["g"]).collect()}
    for g in (None, "g0", "g1", "g2"):
        for i, v in ((1, "x"), (2, "y")):
            assert np.allclose(got[g, v], np.percentile([r[i] for r in rows if r[0] == g and r[i] is not None], [0, 1, 25, 50, 99, 100]))
    assert got["one", "x"] == [4.0] * 6 and ("one", "y") not in got
    assert quantiles.percentiles(df.limit(0), ["x"], [0.5]).count() == 0


def test_rules_of_the_data_model(spark):
    one = lambda c, *v: [r[0] for r in spark.createDataFrame([(x,) for x in v], "x string").select(c(F.col("x"))).collect()]
    assert one(text.status_from_name, "x.calificadas_z.pdf", "a_PreCalificada_b.pdf", "calificados.pdf", "recalificada.pdf") == [None, "precalificada", "calificada", None]
    assert one(numbers.percent_value, "% máximo = 25%", "% máximo = ,6%", "1.5 %", "1.234%", "-2,5 %", "x") == [25.0, 0.6, 5.0, 234.0, -2.5, None]
    assert one(text.clean_category, "\tn/a", "\tCasa\u00a0", " S/I\n", "a \t b", None) == [None, "casa", None, "a b", None]
    renamed = tables.resolve_aliases(spark.createDataFrame([(1, 2)], ["superficie", "sup_util"]))
    assert renamed.columns == ["superficie_util", "sup_util"]
    assert one(text.safe_region_id, "a b/c", "..") == ["a_b_c", "region"]


def test_noise_widens_the_ranges(spark):
    rows = [(i, float(i % 10), i // 10) for i in range(20)] + [(20, 1000.0, -1)]
    df = spark.createDataFrame(rows, "id long, x double, label int")
    means = clustering.mean_distances(df, "id", ["x"], [], "label").collect()
    assert {r["id"] for r in means} == set(range(20))
    own = next(r for r in means if r["id"] == 0 and r["other"] == 0)
    assert abs(own["mean_distance"] - np.mean([abs(k) / 1000 for k in range(1, 10)])) < 1e-12 and own["size"] == 10
    one = features.imputation_for_distances(spark.createDataFrame([(1.0, None), (3.0, "a"), (None, "a")], "x double, c string"), ["x"], ["c"])
    assert one == {"x": 2.0, "c": "desconocido"}


def test_random_sample(spark):
    df = spark.range(100)
    first = [r[0] for r in relational.random_sample(df, 10, 3).collect()]
    assert len(set(first)) == 10 and relational.random_sample(df, 500).count() == 100


def test_components(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + (i % 3), "a" if i % 2 else "b") for i in range(60)], "x double, y double, k string")
    scores, model = features.pca(df, ["x", "y"], ["k"], 2)
    x = np.array([[r["x"], r["y"], r["k_a"], r["k_b"]] for r in scores.collect()])
    assert np.allclose(sorted(np.linalg.eigvalsh(np.cov(x.T)))[::-1][:2], model.variances)
    assert abs(scores.agg(F.avg("pc1")).first()[0]) < 1e-9


def test_cluster_input(spark):
    cols = [" Superficie  Util", "ZT", "tipo_inmueble", "calef_proyec_kwh", "acs_proyec_kwh", "u_norm_muro_principal", "u_norm_muro_secundario", "u_norm_techo_principal", "u_norm_techo_secundario"]
    row = ("57,2", "I", "Casa", "22.428,6", "0", "0.6", "0.6", "0.25", "s/i")
    df, numeric, categorical = tables.cluster_input(spark.createDataFrame([row, row], cols))
    assert df.count() == 1 and df.first()["superficie_util"] == 57.2 and df.first()["calef_proyec_kwh"] == 22428.6 and df.first()["u_norm_techo_secundario"] is None
    assert "log_acs_proyec_kwh" in numeric and categorical == ["zona_termica", "tipo_inmueble"]
    with pytest.raises(ValueError, match="no reader"):
        tables.read(spark, "x.doc")
