"""The footprint table: one row per shot, the variables of four products side by side.

Names and bins are fixed values of the data model; types are declared once, so that absent products are typed NULLs
and every file of the lake can be read together.
"""

from __future__ import annotations

from pyspark.sql import types as T

PRODUCTS = ("level2A", "level2B", "level4A", "level4C")

FLOAT, DOUBLE, INT, TEXT, PROFILE = T.FloatType(), T.DoubleType(), T.IntegerType(), T.StringType(), T.ArrayType(T.FloatType())

# Variables by product, in order, and the bins of profiles.
VARIABLES = {
    "level2A": [
        T.StructField("elev_lowestmode", FLOAT),
        T.StructField("delta_time", DOUBLE),
        T.StructField("sensitivity", DOUBLE),
        T.StructField("sensitivity_a1", DOUBLE),
        T.StructField("sensitivity_a2", DOUBLE),
        T.StructField("degrade_flag", INT),
        T.StructField("quality_flag", INT),
        T.StructField("landsat_treecover", FLOAT),
        T.StructField("modis_treecover", FLOAT),
        T.StructField("modis_treecover_sd", FLOAT),
        T.StructField("modis_nonvegetated", FLOAT),
        T.StructField("modis_nonvegetated_sd", FLOAT),
        T.StructField("solar_elevation", FLOAT),
        T.StructField("solar_azimuth", FLOAT),
        T.StructField("energy_total", FLOAT),
        T.StructField("digital_elevation_model", FLOAT),
        T.StructField("digital_elevation_model_srtm", FLOAT),
        T.StructField("num_detectedmodes", INT),
        T.StructField("rh", PROFILE, metadata={"bins": 101}),
        T.StructField("selected_algorithm", INT),
        T.StructField("surface_flag", INT),
        T.StructField("elev_highestreturn_a1", FLOAT),
        T.StructField("elev_highestreturn_a2", FLOAT),
        T.StructField("stale_return_flag", INT),
        T.StructField("rx_maxamp", FLOAT),
        T.StructField("sd_corrected", FLOAT),
        T.StructField("rx_algrunflag", INT),
        T.StructField("zcross", FLOAT),
        T.StructField("toploc", FLOAT),
    ],
    "level2B": [
        T.StructField("l2b_algorithm_run_flag", INT),
        T.StructField("l2a_quality_flag", INT),
        T.StructField("l2b_quality_flag", INT),
        T.StructField("cover", FLOAT),
        T.StructField("cover_z", PROFILE, metadata={"bins": 30}),
        T.StructField("fhd_normal", FLOAT),
        T.StructField("omega", FLOAT),
        T.StructField("pai", FLOAT),
        T.StructField("pai_z", PROFILE, metadata={"bins": 30}),
        T.StructField("pavd_z", PROFILE, metadata={"bins": 30}),
        T.StructField("pgap_theta", FLOAT),
        T.StructField("pgap_theta_error", FLOAT),
        T.StructField("rg", FLOAT),
        T.StructField("rhog", FLOAT),
        T.StructField("rhog_error", FLOAT),
        T.StructField("rhov", FLOAT),
        T.StructField("rhov_error", FLOAT),
        T.StructField("rossg", FLOAT),
        T.StructField("rv", FLOAT),
        T.StructField("rx_range_highestreturn", FLOAT),
        T.StructField("selected_l2a_algorithm", INT),
        T.StructField("selected_rg_algorithm", INT),
        T.StructField("dz", FLOAT),
    ],
    "level4A": [
        T.StructField("l2_quality_flag", INT),
        T.StructField("l4_quality_flag", INT),
        T.StructField("l4_algorithm_run_flag", INT),
        T.StructField("xvar", FLOAT),
        T.StructField("predictor_limit_flag", INT),
        T.StructField("response_limit_flag", INT),
        T.StructField("agbd", DOUBLE),
        T.StructField("agbd_pi_lower", FLOAT),
        T.StructField("agbd_pi_upper", FLOAT),
        T.StructField("agbd_se", FLOAT),
        T.StructField("agbd_t", FLOAT),
        T.StructField("agbd_t_se", FLOAT),
        T.StructField("predict_stratum", TEXT),
        T.StructField("landsat_water_persistence", FLOAT),
        T.StructField("leaf_off_flag", INT),
        T.StructField("leaf_off_doy", INT),
        T.StructField("leaf_on_cycle", INT),
        T.StructField("leaf_on_doy", INT),
        T.StructField("urban_proportion", FLOAT),
        T.StructField("pft_class", INT),
        T.StructField("region_class", INT),
    ],
    "level4C": [
        T.StructField("wsci", FLOAT),
        T.StructField("wsci_pi_lower", FLOAT),
        T.StructField("wsci_pi_upper", FLOAT),
        T.StructField("wsci_quality_flag", INT),
        T.StructField("wsci_xy", FLOAT),
        T.StructField("wsci_xy_pi_lower", FLOAT),
        T.StructField("wsci_xy_pi_upper", FLOAT),
        T.StructField("wsci_z", FLOAT),
        T.StructField("wsci_z_pi_lower", FLOAT),
        T.StructField("wsci_z_pi_upper", FLOAT),
    ],
}
# Variables that are one number a beam.
ANCILLARY = ("dz",)


def product_fields(product: str) -> list[T.StructField]:
    """Variables of a product as its source has them, profiles as arrays; the metadata names the product."""
    return [T.StructField(f.name, f.dataType, metadata={**(f.metadata or {}), "level": product}) for f in VARIABLES[product]]


def unrolled(fields: list[T.StructField]) -> list[T.StructField]:
    """Fields with each profile as columns name_0 to name_{bins - 1}."""
    out = []
    for f in fields:
        if isinstance(f.dataType, T.ArrayType):
            out += [T.StructField(f"{f.name}_{i}", f.dataType.elementType, metadata={"level": f.metadata.get("level"), "bin": i}) for i in range(f.metadata["bins"])]
        else:
            out.append(f)
    return out


def product_schema(product: str) -> T.StructType:
    """A product's table: key, beam, place, variables."""
    key = [T.StructField("granule_key", T.StringType()), T.StructField("beam_name", T.StringType()), T.StructField("shot_number", T.LongType())]
    place = [T.StructField("lat_lowestmode", T.DoubleType()), T.StructField("lon_lowestmode", T.DoubleType())]
    return T.StructType(key + place + product_fields(product))


def _told(name: str, kind: T.DataType, unit: str, description: str) -> T.StructField:
    return T.StructField(name, kind, metadata={"unit": unit, "description": description, "level": "derived"})


DERIVED = [
    _told("absolute_time", T.TimestampType(), "UTC timestamp", "Time of the shot, from delta_time"),
    _told("granule", T.StringType(), "N/A", "Key of the granule, from its file name"),
    _told("tile_id", T.StringType(), "N/A", "1x1 degree tile of the shot, from its place"),
    _told("beam_name", T.StringType(), "N/A", "Name of the beam"),
    _told("year", T.IntegerType(), "year", "Year of absolute_time"),
]


def lake_schema() -> T.StructType:
    """The stored table; tile_id and year are its partitions."""
    place = [T.StructField("shot_number", T.LongType()), T.StructField("lat_lowestmode", T.DoubleType()), T.StructField("lon_lowestmode", T.DoubleType())]
    variables = [f for p in PRODUCTS for f in unrolled(product_fields(p))]
    derived = {f.name: f for f in DERIVED}
    return T.StructType(place + variables + [derived[n] for n in ("absolute_time", "granule", "beam_name", "tile_id", "year")])
