"""The high-risk label: clusters in RFM space and the choice of the riskiest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import sql
from riskframe.functions.columns import replace_columns
from riskframe.functions.scalars import flag_equal
from riskframe.operators import kmeans
from riskframe.operators.features import rfm
from riskframe.operators.scale import PopulationScaler
from riskframe.schema import AMOUNT, CUSTOMER_ID, LABEL, RFM, START_TIME
from riskframe.session import stage

SCALED = tuple(f"scaled_{c}" for c in RFM)


def scaled_rfm(table: DataFrame) -> DataFrame:
    """RFM with the three standardized columns beside the plain ones."""
    copies = replace_columns(table, dict(zip(SCALED, RFM)))
    return PopulationScaler(inputCols=list(SCALED)).fit(copies).transform(copies)


def assign_cluster(df: DataFrame, centroids: Mapping[int, Sequence[float]]) -> DataFrame:
    """The nearest of the given centroids; equally near ones go to the lower id."""
    choices = []
    for cluster, centre in sorted(centroids.items()):
        squared = " + ".join(f"power({s} - {sql.number(x)}, 2)" for s, x in zip(SCALED, centre))
        choices.append(f"struct({squared} as d, {cluster} as id)")
    return df.selectExpr("*", f"least({', '.join(choices)}).id as Cluster")


def cluster_profile(df: DataFrame) -> DataFrame:
    """Mean recency, frequency and monetary, and the number of customers, per cluster."""
    recency, frequency, monetary = RFM
    return df.groupBy("Cluster").agg(
        F.avg(recency).alias("avg_recency"),
        F.avg(frequency).alias("avg_frequency"),
        F.avg(monetary).alias("avg_monetary"),
        F.count(F.lit(1)).alias("count"),
    )


def high_risk_cluster(profile: DataFrame) -> DataFrame:
    """One row: the cluster longest inactive; then least frequent, least monetary."""
    return (
        profile.orderBy(F.desc("avg_recency"), "avg_frequency", "avg_monetary", "Cluster")
        .limit(1)
        .select("Cluster")
    )


def flag_high_risk(clustered: DataFrame) -> DataFrame:
    """Adds the 0/1 label; the riskiest cluster is found first and is one number."""
    risky = high_risk_cluster(cluster_profile(clustered)).first()
    if risky is None:
        return clustered.withColumn(LABEL, F.lit(None).cast("int"))
    return clustered.withColumn(LABEL, flag_equal("Cluster", F.lit(risky["Cluster"])))


def fit_kmeans(
    scaled: DataFrame,
    n_clusters: int = 3,
    random_state: int = 42,
    customer_id_col: str = CUSTOMER_ID,
    n_starts: int = 4,
) -> kmeans.KMeansFit:
    return kmeans.fit(scaled, SCALED, customer_id_col, n_clusters, random_state, n_starts)


def label_rfm(
    table: DataFrame,
    customer_id_col: str = CUSTOMER_ID,
    n_clusters: int = 3,
    random_state: int = 42,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Cluster a stored RFM table and flag the high-risk cluster; ``keep`` carries columns along."""
    scaled = scaled_rfm(table)
    clustered = fit_kmeans(scaled, n_clusters, random_state, customer_id_col).transform(scaled)
    return flag_high_risk(clustered).select(customer_id_col, *keep, *RFM, "Cluster", LABEL)


def high_risk_target(
    df: DataFrame,
    customer_id_col: str = CUSTOMER_ID,
    timestamp_col: str = START_TIME,
    amount_col: str = AMOUNT,
    n_clusters: int = 3,
    random_state: int = 42,
    on_bad_timestamp: str = "raise",
    formats: Sequence[str] = (),
) -> DataFrame:
    """RFM, cluster and 0/1 label of each customer.

    The label is the ``is_high_risk`` column of the result. The RFM table is stored
    once, since k-means passes over it many times.
    """
    made = rfm(df, customer_id_col, timestamp_col, amount_col, on_bad_timestamp, formats)
    table = stage(made, "rfm")
    return label_rfm(table, customer_id_col, n_clusters, random_state)
