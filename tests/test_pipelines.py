"""End-to-end pot pipeline on hand-made drops shaped like FIXTURES.md (not golden data)."""

import os
import tempfile

import pytest

from haulkit import constants as K
from haulkit.plans import pipelines as P


def _w(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def pot_inputs():
    root = tempfile.mkdtemp(prefix="potdrops-")
    cat, spc, raw = (os.path.join(root, d) for d in ("catch", "specimen", "raw"))
    _w(cat, "D1_CATCH_0001.csv", [
        "HAUL,HAUL_ID,RECORDING_DEVICE,ID,CRUISE,VESSEL,STATION,SPECIES_CODE,SPECIES_NAME,NUMBER_CRAB,WEIGHT",
        "1,h1,dev,c1,202401,162,A1,69322,red king crab,8,10.5"])
    _w(cat, "D2_CATCH_0002.csv", [      # an "unresolved" file without STATION
        "HAUL,HAUL_ID,RECORDING_DEVICE,ID,CRUISE,VESSEL,SPECIES_CODE,SPECIES_NAME,NUMBER_CRAB,WEIGHT",
        "2,h2,dev,c2,202401,162,68560,Tanner crab,1,0.4"])
    _w(spc, "D1_SPECIMEN_0001.csv", [
        "HAUL,HAUL_ID,SPECIES_CODE,SEX,LENGTH,WIDTH,SHELL_CONDITION,EGG_COLOR,EGG_CONDITION,CLUTCH_SIZE,DISEASE_CODE,"
        "DISEASE_DORSAL,DISEASE_VENTRAL,DISEASE_LEGS,CHELA_HEIGHT,MERUS_LENGTH,COMMENTS,NOTES,STATION",
        "1,h1,69322,1,130,NA,2,NA,NA,NA,NA,NA,NA,NA,NA,NA,ok,n,A1"])
    _w(raw, "R_SAMPLE_0001.csv", [
        "HAUL_ID,CATCH_SAMPLE_ID,PARENT_SAMPLE_ID,MIX,SAMPLED_ALL,SPECIES_CODE,SPECIES_NAME,SEX,RECORDING_DEVICE,RECORDER",
        "h1,s1,NA,N,N,69322,red king crab,1,dev,me", "h1,s2,NA,N,N,69322,red king crab,2,dev,me"])
    _w(raw, "R_SAMPLE_VALUES_0001.csv", [
        "HAUL_ID,CATCH_SAMPLE_VALUE_ID,CATCH_SAMPLE_ID,COUNT,WEIGHT,KEEP,RECORDING_DEVICE,RECORDER",
        "h1,v1,s1,2,1.0,N,dev,me", "h1,v2,s1,NA,0.5,Y,dev,me", "h1,v3,s2,1,0.3,N,dev,me"])
    _w(raw, "R_SPECIMEN_0001.csv", ["HAUL_ID,SPECIMEN_ID,CATCH_SAMPLE_ID,SPECIES_CODE,RECORDING_DEVICE"]
       + [f"h1,m{i},s1,69322,dev" for i in range(3)] + [f"h1,f{i},s2,69322,dev" for i in range(2)])
    bio = ["HAUL_ID,SPECIMEN_ID,BIOMETRIC_NAME,VALUE,RECORDING_DEVICE"]
    for i, ln in enumerate((130, 140, 100)):
        bio += [f"h1,m{i},SEX,1,dev", f"h1,m{i},CARAPACE_LENGTH,{ln},dev", f"h1,m{i},CRAB_SHELL_CONDITION,2,dev"]
    for i, cl in enumerate((3, 0)):
        bio += [f"h1,f{i},SEX,2,dev", f"h1,f{i},CARAPACE_LENGTH,95,dev", f"h1,f{i},CRAB_EGG_CLUTCH_SIZE,{cl},dev",
                f"h1,f{i},CRAB_EGG_COLOR,2,dev", f"h1,f{i},CRAB_EGG_CONDITION,2,dev", f"h1,f{i},CRAB_SHELL_CONDITION,2,dev"]
    _w(raw, "R_SPECIMEN_BIOMETRICS_0001.csv", bio)
    hdr = ("VESSEL,SPN,POT_ID,BUOY,DATE_SET,TIME_SET,DATE_HAUL,TIME_HAUL,LAT_DEG,LAT_MIN,LON_DEG,LON_MIN,DEPTH_F,"
           "GEAR_CODE,TEMP_LOGGER,NOTES")
    _w(root, "Mar_PotLifts.csv", [hdr,
                                  "162,1,A1,7,3/10/2026,900,3/11/2026,1500,56,30,161,15,40,,T1,x",
                                  "162,2,A2,8,3/10/2026,905,3/11/2026,1505,56,31,161,16,41,44,T2,",
                                  "162,3,CAM1,9,3/10/2026,910,3/11/2026,,56,32,161,17,42,,T3,no haul time"])
    _w(root, "Pro_PotLifts.csv", [hdr,
                                  "134,215,B1,5,3/12/2026,800,3/13/2026,800,57,0,160,0,30,42,T4,excluded",
                                  "134,4,B2,6,3/12/2026,800,3/13/2026,800,57,1,160,1,30,7,T5,"])
    _w(root, "Mar_Bycatch.csv", [
        "VESSEL,SPN,POT_ID,DATE_HAUL," + ",".join(K.POT_BYCATCH_COLUMNS),
        "162,1,A1,3/11/2026,1,2,0,0,0,0,1,3,0,0,1,0,0,NA", "162,9,Z9,3/11/2026,1,0,0,0,0,0,0,0,0,0,0,0,0,0"])
    return P.PotInputs(cat, spc, raw, [os.path.join(root, "Mar_PotLifts.csv"), os.path.join(root, "Pro_PotLifts.csv")],
                       [os.path.join(root, "Mar_Bycatch.csv")])


def test_pot_pipeline_products(spark, pot_inputs):
    out = P.pot(spark, pot_inputs)
    st = out["specimen_table"].collect()
    assert len(st) == 5 and {r["VESSEL"] for r in st} == {"Marahute"}
    sf = sorted((r["SEX"], round(r["SAMPLING_FACTOR"], 6)) for r in st)
    assert sf == [(1, round(5 / 3, 6))] * 3 + [(2, 1.5)] * 2          # tossed 2 of 3 kept males, 1 of 2 females
    assert {r["SOAK_TIME"] for r in st} == {30.0}
    lifts = {r["SPN"]: r for r in out["potlifts"].collect()}
    # no haul time (3) dropped; excluded SPN 215 dropped; gear 7 blanked on the second sheet (kept as '')
    assert set(lifts) == {1, 2, 4} and lifts[4]["GEAR_CODE"] == ""
    cpue = out["pot_cpue"].collect()
    assert len(cpue) == 3 * 6
    got = {(r["SPN"], r["MAT_SEX"]): (r["COUNT"], r["CATCH_PER_HOUR"]) for r in cpue}
    assert got[(1, "Mature male")][0] == pytest.approx(10 / 3) and got[(1, "Legal male")][0] == pytest.approx(5 / 3)
    assert got[(1, "Mature female")] == (pytest.approx(1.5), pytest.approx(1.5 / 30))
    assert got[(2, "Mature male")] == (0.0, None)                       # zero pot: rate stays NULL (N17)
    cs = out["catch_summary"].collect()
    assert [(r["SPN"], r["NUMBER_CRAB"], r["N_ENTRIES"]) for r in cs] == [(1, pytest.approx(8.0), 8)]
    assert out["catch_mismatches"].count() == 0
    by = out["pot_bycatch"].collect()
    assert len(by) == 1 and by[0]["Tanner"] == 3 and by[0]["Other"] == 0   # unknown lift 9 dropped, NA -> 0
    rep = {r["RULE_ID"]: r["VIOLATIONS"] for r in out["quality_report"].collect()}
    assert rep["Q2"] == 0 and rep["Q21"] == 0
    assert out["orphan_units"].count() == 0
    assert out["fanout_samples"].count() == 0 and out["fanout_potlifts"].count() == 0


def test_pot_lifted_twice_reconciles_by_lift(spark, pot_inputs):
    rows = P.pot(spark, pot_inputs)["catch_reconcile"].collect()
    assert {"SPN", "POT_ID"} <= set(rows[0].asDict())
    # expanded numbers agree; five crab were measured of the eight that the catch file reports
    assert [(r["SPN"], r["SPEC_NUMBER_CRAB"], r["CATCH_NUMBER_CRAB"], r["SPEC_N_ENTRIES"], r["CATCH_N_ENTRIES"]) for r in rows] == [
        (1, pytest.approx(8.0), pytest.approx(8.0), 5, 8)]


def test_layers_from_products(spark, pot_inputs):
    out = P.pot(spark, pot_inputs)
    trawl_cpue = spark.createDataFrame([("Vesteraalen", 7, 56.0, -161.0, "Mature male", 4.0)],
                                       "VESSEL string, STATION long, LAT_DD double, LON_DD double, MAT_SEX string, COUNT double")
    lay = P.layers(out["pot_cpue"], trawl_cpue)
    assert lay["cpue_layer"].count() == 3 * 6 + 1
    gears = {r["GEAR"] for r in lay["cpue_layer"].collect()}
    assert gears == {"POT", "TRAWL"}
    lim = {(r["GEAR"], r["CATEGORY"]): r["SCALE_LIMIT"] for r in lay["cpue_scales"].collect()}
    assert lim[("TRAWL", "Mature male")] == 5.0


@pytest.fixture(scope="module")
def trawl_root():
    root = tempfile.mkdtemp(prefix="trawldrops-")
    _w(root, "VA_HAULS.csv", ["SAMPLED,STATION,LAT_DD,LON_DD", "1,S1,56.1,-161.2", "1,S2,56.3,-161.4",
                              "0,S3,56.5,-161.6"])
    return root


def test_trawl_pipeline(spark, trawl_root):
    cat, spc, raw = (os.path.join(trawl_root, d) for d in ("catch", "specimen", "raw"))
    _w(cat, "T_CATCH_0001.csv", [
        "HAUL,HAUL_ID,RECORDING_DEVICE,ID,CRUISE,VESSEL,STATION,SPECIES_CODE,SPECIES_NAME,NUMBER_CRAB,WEIGHT",
        "1,t1,dev,c1,202401,176,S1,69322,red king crab,2,3.0", "1,t1,dev,c2,202401,176,S1,68560,Tanner crab,1,0.2"])
    _w(spc, "T_SPECIMEN_0001.csv", [
        "HAUL,HAUL_ID,SPECIES_CODE,SEX,LENGTH,WIDTH,SHELL_CONDITION,EGG_COLOR,EGG_CONDITION,CLUTCH_SIZE,DISEASE_CODE,"
        "DISEASE_DORSAL,DISEASE_VENTRAL,DISEASE_LEGS,CHELA_HEIGHT,MERUS_LENGTH,COMMENTS,NOTES,STATION",
        "1,t1,69322,1,140,NA,2,NA,NA,NA,NA,NA,NA,NA,NA,NA,,,S1"])
    _w(raw, "T_SAMPLE_0001.csv", [
        "HAUL_ID,CATCH_SAMPLE_ID,PARENT_SAMPLE_ID,MIX,SAMPLED_ALL,SPECIES_CODE,SPECIES_NAME,SEX,RECORDING_DEVICE,RECORDER",
        "t1,s1,NA,N,Y,69322,red king crab,1,dev,me", "t1,s2,NA,N,Y,68560,Tanner crab,2,dev,me"])
    _w(raw, "T_SAMPLE_VALUES_0001.csv", [
        "HAUL_ID,CATCH_SAMPLE_VALUE_ID,CATCH_SAMPLE_ID,COUNT,WEIGHT,KEEP,RECORDING_DEVICE,RECORDER",
        "t1,v1,s1,NA,1.5,Y,dev,me", "t1,v2,s1,NA,1.0,Y,dev,me", "t1,v3,s2,NA,0.2,Y,dev,me"])
    _w(raw, "T_SPECIMEN_0001.csv", ["HAUL_ID,SPECIMEN_ID,CATCH_SAMPLE_ID,SPECIES_CODE,RECORDING_DEVICE",
                                    "t1,a,s1,69322,dev", "t1,b,s1,69322,dev", "t1,c,s2,68560,dev"])
    _w(raw, "T_SPECIMEN_BIOMETRICS_0001.csv", [
        "HAUL_ID,SPECIMEN_ID,BIOMETRIC_NAME,VALUE,RECORDING_DEVICE",
        "t1,a,SEX,1,dev", "t1,a,CARAPACE_LENGTH,140,dev", "t1,b,SEX,1,dev", "t1,b,CARAPACE_LENGTH,110,dev",
        "t1,c,SEX,2,dev", "t1,c,CARAPACE_WIDTH,80,dev"])
    out = P.trawl(spark, P.TrawlInputs(cat, spc, raw, os.path.join(trawl_root, "VA_HAULS.csv")))
    st = out["specimen_table"].collect()
    assert len(st) == 3 and {r["VESSEL"] for r in st} == {"Vesteraalen"} and {r["SAMPLING_FACTOR"] for r in st} == {1.0}
    cpue = {(r["STATION"], r["MAT_SEX"]): r["COUNT"] for r in out["trawl_cpue"].collect()}
    assert len(cpue) == 2 * 6                      # unsampled station S3 dropped
    assert cpue[("S1", "Mature male")] == 1.0 and cpue[("S1", "Legal male")] == 1.0 and cpue[("S2", "Mature male")] == 0.0
    by = {r["STATION"]: r for r in out["crab_bycatch"].collect()}
    assert by["S1"]["FemaleTanner"] == 1.0 and by["S1"]["Tanner"] == 1.0 and by["S2"]["Tanner"] == 0.0
    cs = {(r["SPECIES_CODE"]): (r["NUMBER_CRAB"], r["N_ENTRIES"]) for r in out["catch_summary"].collect()}
    assert cs[69322] == (2.0, 2)
    assert out["quality_report"].count() == 21
    assert out["duplicate_biometrics"].count() == 0
    assert {r["HAUL"] for r in out["trawl_cpue"].where("COUNT > 0").collect()} == {1}


def test_trawl_station_towed_twice_counts_a_crab_once_at_each_tow(spark, trawl_root):
    cat, spc, raw = (os.path.join(trawl_root, d) for d in ("catch", "specimen", "raw"))
    _w(trawl_root, "VA_HAULS2.csv", ["SAMPLED,STATION,LAT_DD,LON_DD", "1,S1,56.1,-161.2", "1,S1,56.15,-161.2", "1,S2,56.3,-161.4"])
    out = P.trawl(spark, P.TrawlInputs(cat, spc, raw, os.path.join(trawl_root, "VA_HAULS2.csv")))
    cpue = {(r["STATION"], r["LAT_DD"], r["MAT_SEX"]): r["COUNT"] for r in out["trawl_cpue"].collect()}
    assert len(cpue) == 3 * 6 and cpue[("S1", 56.1, "Mature male")] == cpue[("S1", 56.15, "Mature male")] == 1.0
    by = {(r["STATION"], r["LAT_DD"]): r["Tanner"] for r in out["crab_bycatch"].collect()}
    assert by == {("S1", 56.1): 1.0, ("S1", 56.15): 1.0, ("S2", 56.3): 0.0}


def test_trawl_biometrics_entered_twice(spark, trawl_root):
    """The same value twice is one value; two values make the cell NULL and are listed."""
    cat, spc, raw = (os.path.join(trawl_root, d) for d in ("catch", "specimen", "raw"))
    raw2 = os.path.join(trawl_root, "raw2")
    for f in os.listdir(raw):
        _w(raw2, f, open(os.path.join(raw, f)).read().rstrip("\n").split("\n"))
    _w(raw2, "T_SPECIMEN_BIOMETRICS_0002.csv", ["HAUL_ID,SPECIMEN_ID,BIOMETRIC_NAME,VALUE,RECORDING_DEVICE",
                                                "t1,a,SEX,1,dev", "t1,b,CARAPACE_LENGTH,115,dev"])
    out = P.trawl(spark, P.TrawlInputs(cat, spc, raw2, os.path.join(trawl_root, "VA_HAULS.csv")))
    assert [(r["SPECIMEN_ID"], r["BIOMETRIC_NAME"]) for r in out["duplicate_biometrics"].collect()] == [("b", "CARAPACE_LENGTH")]
    st = sorted((r["SEX"], r["LENGTH"] or 0.0) for r in out["specimen_table"].collect())
    assert st == [(1, 0.0), (1, 140.0), (2, 0.0)]


def test_fish_pipeline(spark, trawl_root):
    cat, raw = os.path.join(trawl_root, "fcatch"), os.path.join(trawl_root, "fraw")
    _w(cat, "F_CATCH_0001.csv", [
        "HAUL,HAUL_ID,RECORDING_DEVICE,ID,CRUISE,VESSEL,STATION,SPECIES_CODE,SPECIES_NAME,NUMBER_CRAB,WEIGHT",
        "1,t1,dev,c1,202401,176,S1,10210,yellowfin sole,NA,1", "1,t1,dev,c2,202401,176,S1,10001,flatfish unid.,NA,1",
        "1,t1,dev,c3,202401,176,S1,21722,Pacific cod (adult),NA,1"])
    _w(raw, "F_SAMPLE_0001.csv", [
        "HAUL_ID,CATCH_SAMPLE_ID,PARENT_SAMPLE_ID,MIX,SAMPLED_ALL,SPECIES_CODE,SPECIES_NAME,SEX,RECORDING_DEVICE,RECORDER",
        "t1,a,NA,N,Y,10210,,NA,dev,me", "t1,b,NA,N,Y,10001,,NA,dev,me", "t1,c,NA,N,Y,21722,,NA,dev,me",
        "t1,d,NA,N,Y,69322,,NA,dev,me"])
    _w(raw, "F_CATCH_VALUE_0001.csv", [
        "CATCH_SAMPLE_VALUE_ID,CATCH_SAMPLE_ID,SAMPLE_VALUE_WEIGHT,SAMPLE_VALUE_WEIGHT_UNITS,SAMPLE_VALUE_COUNT,KEEP_FLAG,RECORDING_DEVICE,RECORDER",
        "v1,a,6.0,KG,3,Y,dev,me", "v2,a,4.0,KG,NA,Y,dev,me", "v3,b,5.0,KG,NA,Y,dev,me", "v4,c,9.0,KG,3,Y,dev,me",
        "v5,d,1.0,KG,1,Y,dev,me"])
    _w(raw, "F_HAUL_0001.csv", ["HAUL_ID,CRUISE_ID,HAUL,STATION,RECORDING_DEVICE,WEIGHT,WEIGHT_UNITS",
                                "t1,202401,1,S1,dev,100,KG"])
    out = P.fish(spark, P.FishInputs(cat, raw, os.path.join(trawl_root, "VA_HAULS.csv")))
    fc = {r["SPECIES_CODE"]: r for r in out["fish_catch"].collect()}
    assert set(fc) == {10210, 21720}                          # crab removed, unid. bin folded, cod merged
    assert fc[10210]["SAMPLING_FACTOR"] == pytest.approx(1.5) and fc[10210]["CALC_WEIGHT"] == pytest.approx(15.0)
    assert fc[10210]["COUNT"] == pytest.approx(5.0) and fc[21720]["SPECIES_NAME"] == "Pacific cod"
    sheet = {r["STATION"]: r for r in out["fish_bycatch"].collect()}
    assert sheet["S1"]["YellowfinSole"] == pytest.approx(15.0) and sheet["S1"]["PacificCod"] == pytest.approx(9.0)
    assert sheet["S2"]["PacificCod"] == 0.0
    _w(trawl_root, "VA_HAULS3.csv", ["SAMPLED,STATION,LAT_DD,LON_DD", "1,S1,56.1,-161.2", "1,S1,56.15,-161.2"])
    twice = P.fish(spark, P.FishInputs(cat, raw, os.path.join(trawl_root, "VA_HAULS3.csv")))["fish_bycatch"].collect()
    assert [(r["PacificCod"], r["YellowfinSole"]) for r in twice] == [(pytest.approx(9.0), pytest.approx(15.0))] * 2


def test_shell_layer(spark, pot_inputs):
    out = P.pot(spark, pot_inputs)
    trawl_cpue = spark.createDataFrame([("Vesteraalen", 7, 56.0, -161.0, "Mature male", 1.0)],
                                       "VESSEL string, STATION long, LAT_DD double, LON_DD double, MAT_SEX string, COUNT double")
    trawl_spec = spark.createDataFrame([("Vesteraalen", 7, 69322, 1, 130.0, None, 3, 1.0)],
                                       "VESSEL string, STATION long, SPECIES_CODE int, SEX int, LENGTH double, "
                                       "CLUTCH_SIZE int, SHELL_CONDITION int, SAMPLING_FACTOR double")
    lay = P.layers(out["pot_cpue"], trawl_cpue, pot_specimens=out["specimen_table"], trawl_specimens=trawl_spec)
    sl = {(r["STATION"], r["MAT_SEX_SC"]): r["COUNT"] for r in lay["shell_layer"].collect()}
    assert len(sl) == (3 + 1) * 6                        # every station of the CPUE layer x 6 classes
    assert sl[("7", "Mature male SC3")] == 1.0
    assert sl[("A1", "Mature male SC2")] == pytest.approx(10 / 3)   # two mature SC2 males, factor 5/3
    assert sl[("A2", "Mature female SC2")] == 0.0


def test_pot_options_and_written_products(spark, pot_inputs):
    from haulkit.sources.drops import load_product
    out = P.pot(spark, pot_inputs, zero_rate=True)
    got = {(r["SPN"], r["MAT_SEX"]): r["CATCH_PER_HOUR"] for r in out["pot_cpue"].collect()}
    assert got[(2, "Mature male")] == 0.0                  # N17 option: zero pots get rate 0
    base = tempfile.mkdtemp(prefix="products-")
    P.write_products({k: out[k] for k in ("pot_cpue", "potlifts", "quality_report")}, base, "2026")
    back = load_product(spark, base, "pot_cpue", "2026")
    assert back.count() == 3 * 6 and set(back.columns) >= {"SPN", "MAT_SEX", "COUNT", "survey"}
    assert load_product(spark, base, "quality_report", "2026").count() == 21
