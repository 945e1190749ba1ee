"""Short findings for readers of the reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.numeric import round_half_up
from tallymart.operators.sales import weekend_uplift
from tallymart.params import INSIGHT_ADVICE, INSIGHT_FINDING, Params

# Report texts. "{uplift}" and "{days}" are filled in.
REPORT_ROWS = (
    (
        INSIGHT_FINDING,
        "周末销售高峰",
        "周末日均销售额比工作日高 {uplift}%",
        "建议周五晚至周六集中投放促销资源，增加库存备货",
    ),
    (
        INSIGHT_ADVICE,
        "客户分群运营",
        "通过RFM聚类识别出高价值、高频、流失风险等客户群体",
        "对高价值客户推出VIP专属权益，对流失风险客户发送召回优惠券",
    ),
    (
        INSIGHT_FINDING,
        "销售预测",
        "基于Holt-Winters模型预测未来{days}天销售趋势",
        "根据预测结果提前调整库存和营销预算",
    ),
)
SERVICE_ROWS = (
    (INSIGHT_FINDING, "周末销售高峰", "周末日均销售额比工作日高{uplift}%", "集中促销资源在周末"),
    (INSIGHT_ADVICE, "品类优化", "部分品类存在季节性下滑趋势", "对下滑品类加大促销或调整库存"),
)


def insights(
    df: DataFrame,
    rows: tuple[tuple[str, str, str, str], ...] = REPORT_ROWS,
    forecast_days: int | None = None,
    params: Params = Params(),
) -> DataFrame:
    """The insight texts with the measured weekend uplift, also as a number."""
    days = params.forecast_days if forecast_days is None else forecast_days
    texts = F.array(
        *[
            F.struct(
                F.lit(i).cast("long").alias("position"),
                F.lit(kind).alias("type"),
                F.lit(title).alias("title"),
                F.lit(detail.replace("{days}", str(days))).alias("detail"),
                F.lit(suggestion).alias("suggestion"),
                F.lit("{uplift}" in detail).alias("_measured"),
            )
            for i, (kind, title, detail, suggestion) in enumerate(rows, start=1)
        ]
    )
    uplift = round_half_up(F.col("uplift_pct"), 1)
    shown = uplift.cast("decimal(18,1)").cast("string")
    return (
        weekend_uplift(df, params)
        .select("uplift_pct", F.inline(texts))
        .select(
            "position",
            "type",
            "title",
            F.when(F.col("_measured"), F.replace("detail", F.lit("{uplift}"), shown))
            .otherwise(F.col("detail"))
            .alias("detail"),
            "suggestion",
            F.when(F.col("_measured"), uplift).alias("uplift_pct"),
        )
        .orderBy("position")
    )
