"""The KPI mart kept up to date batch by batch.

Every batch of stays is reduced to mergeable state: one row per dimension value with counts and exact sums.
The mart is the merge of all states, so taking in a batch reads that batch only. State lies in a folder:

* ``batches/batch_id=<id>``: state of one batch; a batch taken in again replaces its own folder;
* ``merged/generation=<g>``: the sum of many batches, made by ``merge`` from time to time;
* ``absorbed/generation=<g>``: the ids of those batches, written last, which makes the generation valid.

A batch that a generation already holds is passed over, so replays never count twice, before or after a merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carestay.functions import columns as C
from carestay.operators import gold

#: What the KPIs are means of; sums are exact (whole numbers, or decimals of the stored digits).
_SUMMED = {"readmission_30j": "decimal(38,0)", "duree_sejour": "decimal(38,0)", "nb_medicaments": "decimal(38,0)", "indice_complexite": "decimal(28,6)",
           "flag_polymedication": "decimal(38,0)", "flag_sortie_complexe": "decimal(38,0)", "age": "decimal(38,0)"}
_KEYS = ["dimension", "valeur", "sous_groupe"]
_STATE = ["n", *[f"{p}_{c}" for c in _SUMMED for p in ("s", "c")]]
_SCHEMA = ", ".join([*[f"{k} string" for k in _KEYS], "n bigint", *[f"s_{c} {'decimal(38,6)' if '6)' in t else 'decimal(38,0)'}, c_{c} bigint" for c, t in _SUMMED.items()]])


def batch_state(features: DataFrame) -> DataFrame:
    """(dimension, valeur, sous_groupe, n, s_*, c_*): counts and sums per dimension value, one scan with map-side combine."""
    wide = features.select(*dict.fromkeys(c for cols, _, _ in gold.KPI_DIMENSIONS.values() for c in cols),
                           *[F.col(c).cast("int" if features.schema[c].dataType.typeName() == "boolean" else t).cast(t).alias(f"_x_{c}")
                             for c, t in _SUMMED.items()])
    aggs = [F.count(F.lit(1)).alias("n")]
    for c, t in _SUMMED.items():
        aggs += [F.sum(f"_x_{c}").cast("decimal(38,6)" if "6)" in t else "decimal(38,0)").alias(f"s_{c}"), F.count(f"_x_{c}").alias(f"c_{c}")]
    sets = [cols for cols, _, _ in gold.KPI_DIMENSIONS.values()]
    firsts = {d: cols[0] for d, (cols, _, _) in gold.KPI_DIMENSIONS.items()}
    agg = wide.groupingSets(sets, *dict.fromkeys(c for s in sets for c in s)).agg(*aggs, *[F.grouping(f).alias(f"_g_{d}") for d, f in firsts.items()])

    def chosen(pick) -> Column:
        return F.coalesce(*[F.when(F.col(f"_g_{d}") == 0, pick(d)) for d in firsts])

    return agg.select(chosen(F.lit).alias("dimension"), chosen(lambda d: gold.KPI_DIMENSIONS[d][1]()).alias("valeur"),
                      chosen(lambda d: gold.KPI_DIMENSIONS[d][2]()).alias("sous_groupe"), *_STATE)


def merged_state(states: DataFrame) -> DataFrame:
    """One row per dimension value from the rows of any number of states."""
    names = [c for c in _STATE]
    types = dict(states.dtypes)
    return states.groupBy(*_KEYS).agg(*[F.sum(c).cast(types[c]).alias(c) for c in names])


def mart_of(state: DataFrame) -> DataFrame:
    """The KPI mart's rows and columns from merged state."""
    mean = lambda c: F.try_divide(F.col(f"s_{c}").cast("double"), F.col(f"c_{c}"))
    kpis = state.select(
        *_KEYS, F.col("n").alias("nb_sejours"), F.col("s_readmission_30j").cast("bigint").alias("nb_readmissions"),
        C.rnd(mean("readmission_30j"), 4).alias("taux_readmission"), C.rnd(mean("duree_sejour"), 2).alias("duree_sejour_moy"),
        C.rnd(mean("nb_medicaments"), 2).alias("nb_medicaments_moy"), C.rnd(mean("indice_complexite"), 2).alias("indice_complexite_moy"),
        C.rnd(mean("flag_polymedication"), 4).alias("taux_polymedication"), C.rnd(mean("flag_sortie_complexe"), 4).alias("taux_sortie_complexe"),
        C.rnd(mean("age"), 1).alias("age_moyen"))
    return gold.deviation_from_dimension_mean(kpis)


class KpiState:
    """The stored state of one mart. ``path`` must be shared by driver and executors."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self, folder: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def _read(self, folder: str, schema: str) -> DataFrame | None:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}") if self._exists(folder) else None

    def generation(self) -> int:
        """The last valid generation; 0 before the first merge."""
        ids = self._read("absorbed", "batch_id string, generation int")
        return (ids.agg(F.max("generation")).first()[0] or 0) if ids is not None else 0

    def absorbed(self) -> DataFrame | None:
        """(batch_id) of the batches in the last valid generation."""
        ids = self._read("absorbed", "batch_id string, generation int")
        return None if ids is None else ids.where(F.col("generation") == self.generation()).select("batch_id")

    def absorb(self, features: DataFrame, batch_id: str) -> bool:
        """Take in a batch of the feature table; returns False if a generation already holds it."""
        held = self.absorbed()
        if held is not None and not held.where(F.col("batch_id") == batch_id).isEmpty():
            return False
        # few rows: one per dimension value
        batch_state(features).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batches/batch_id={batch_id}")
        return True

    def _fresh(self) -> DataFrame | None:
        """State rows of the batches that no generation holds."""
        rows, held = self._read("batches", f"{_SCHEMA}, batch_id string"), self.absorbed()
        return rows if rows is None or held is None else rows.join(held, "batch_id", "left_anti")

    def state(self) -> DataFrame | None:
        """The merged state of all batches, or None before the first batch."""
        parts = [] if (fresh := self._fresh()) is None else [fresh.drop("batch_id")]
        if g := self.generation():
            parts.append(self.spark.read.schema(_SCHEMA).parquet(f"{self.path}/merged/generation={g}"))
        if not parts:
            return None
        return merged_state(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]))

    def mart(self) -> DataFrame:
        """The KPI mart of all batches taken in; a small job over state rows. No batch: no rows."""
        state = self.state()
        return mart_of(self.spark.createDataFrame([], _SCHEMA) if state is None else state)

    def merge(self) -> int:
        """Sum all batches into a new generation; returns its number. A crash before the ids are written leaves the old one valid."""
        fresh, state, g = self._fresh(), self.state(), self.generation() + 1
        if fresh is None:
            return g - 1
        ids, held = fresh.select("batch_id").distinct(), self.absorbed()
        ids = ids if held is None else ids.unionByName(held)
        state.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/merged/generation={g}")
        ids.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/absorbed/generation={g}")
        return g


def batch_sink(path: str, to_features):
    """A ``foreachBatch`` function that keeps the mart's state in step with a stream of stays.

    ``to_features`` turns a micro-batch into feature rows. Spark replays a failed micro-batch under its old id, which replaces its state.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        KpiState(batch.sparkSession, path).absorb(to_features(batch), f"stream-{batch_id}")
    return sink
