"""Written results: long CSV tables, the view export and the JSON document."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketgrain.functions.labels import month_text
from marketgrain.plans.contract import as_json, require_sections
from marketgrain.plans.forecast import Horizon
from marketgrain.operators.summary import materialized
from marketgrain.plans.privacy import enforce_document
from marketgrain.plans.quality import gate

# Headings of the exported long table, and per view the section
# name and metric of each exported block.
TIDY_COLUMNS = ("secao", "dimensao", "periodo", "metrica", "valor", "detalhe")
VIEWS = {
    "overview": ("cards", "monthly", "channels"),
    "customers": ("elite", "elite_categories", "channel_shares"),
    "operations": ("weekdays", "checks"),
    "models": ("forecast", "recommendations", "sources"),
}


def view_sections(view: str) -> list[str]:
    """Sections a view is made of; shares are a second reading of channels."""
    return ["channels" if block == "channel_shares" else block for block in VIEWS[view]]


def fixed_digits(value: str, digits: int) -> Column:
    """A number as text with a fixed count of decimals."""
    return F.format_string(f"%.{digits}f", F.col(value).cast("double")).alias(value)


def number_text(value: Column) -> Column:
    """Shortest plain form: no exponent, no trailing zeros."""
    exact = F.format_string("%.8f", value.cast("double"))
    return F.regexp_replace(exact, r"\.?0+\z", "")


def write_csv(frame: DataFrame, path: str, digits: Mapping[str, int] | None = None) -> None:
    """A folder of CSV parts with headers; chosen columns get fixed digits."""
    shaped = [
        fixed_digits(c, digits[c]) if digits and c in digits else F.col(c) for c in frame.columns
    ]
    frame.select(*shaped).write.mode("errorifexists").option("header", True).option(
        "escape", '"'
    ).csv(path)


def monthly_with_period(series: DataFrame, horizon: Horizon, by: Sequence[str] = ()) -> DataFrame:
    """Monthly series with a train or test mark, as it is exported."""
    in_train = F.col("month") <= F.lit(horizon.train_end)
    return series.select(
        *by,
        month_text(F.col("month")).alias("month"),
        "units",
        F.when(in_train, "train").otherwise("test").alias("period"),
    )


def _block(
    frame: DataFrame,
    section: str,
    *,
    dimension: Column,
    metric: Column,
    value: Column,
    period: Column | None = None,
    detail: Column | None = None,
) -> DataFrame:
    empty = F.lit("")
    cells = (F.lit(section), dimension, empty if period is None else period, metric,
             number_text(value), empty if detail is None else detail)
    return frame.select(*[c.cast("string").alias(n) for c, n in zip(cells, TIDY_COLUMNS)])


def _joined(*parts: tuple[str, Column]) -> Column:
    return F.concat_ws("; ", *[F.concat(F.lit(f"{name}="), text) for name, text in parts])


def tidy_blocks(sections: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every exportable block of the given sections as the six-column table.

    Sections: ``cards``, ``monthly``, ``channels``, ``elite`` (anonymous),
    ``elite_categories``, ``weekdays``, ``checks``, ``forecast``,
    ``recommendations``, ``sources``.
    """
    text = lambda name: F.col(name).cast("string")
    number = lambda name: number_text(F.col(name))
    orders = F.concat(text("orders"), F.lit(" pedidos"))
    shapes = {
        "cards": ("cards", "indicador_executivo", dict(
            dimension=F.col("id"), metric=F.col("format"), value=F.col("value"))),
        "monthly": ("monthly", "serie_mensal", dict(
            dimension=F.lit("valor_bruto_registrado"), period=F.col("month"),
            metric=F.lit("valor_bruto"), value=F.col("revenue"), detail=orders)),
        "channels": ("channels", "canal", dict(
            dimension=F.col("channel"), metric=F.lit("valor_bruto"), value=F.col("revenue"),
            detail=orders)),
        "elite": ("elite", "ranking_elite_anonimizado", dict(
            dimension=F.col("label"), metric=F.lit("ticket_medio"), value=F.col("average_ticket"),
            detail=_joined(("valor_bruto", number("revenue")), ("pedidos", text("frequency")),
                           ("categorias", text("diversity"))))),
        "elite_categories": ("elite_categories", "categoria_elite", dict(
            dimension=F.col("category"), metric=F.lit("quantidade"), value=F.col("units"),
            detail=_joined(("participacao_pct", number("share_pct"))))),
        "channel_shares": ("channels", "canal", dict(
            dimension=F.col("channel"), metric=F.lit("valor_bruto"), value=F.col("revenue"),
            detail=_joined(("pedidos", text("orders")),
                           ("participacao_pedidos_pct", number("order_share_pct"))))),
        "weekdays": ("weekdays", "operacao_pos", dict(
            dimension=F.col("weekday"), metric=F.lit("valor_bruto_medio_diario"),
            value=F.col("mean_sales"),
            detail=_joined(("dias_calendario", text("calendar_days")),
                           ("dias_zero", text("zero_sales_days"))))),
        "checks": ("checks", "check_qualidade", dict(
            dimension=F.col("check"), metric=F.col("status"), value=F.col("value"))),
        "forecast": ("forecast", "previsao", dict(
            dimension=F.lit("demanda_mensal"), period=F.col("month"),
            metric=F.lit("previsao_vs_realizado"), value=F.col("prediction"),
            detail=_joined(("realizado", text("actual")),
                           ("erro_absoluto", number("absolute_error"))))),
        "recommendations": ("recommendations", "recomendacao", dict(
            dimension=F.col("product_name"), metric=F.lit("similaridade_cosseno"),
            value=F.col("similarity"),
            detail=_joined(("clientes_em_comum", text("common_customers"))))),
        "sources": ("sources", "fonte", dict(
            dimension=F.col("table_name"),
            metric=F.when(F.col("used_for_metrics"), "usada_nas_metricas").otherwise("inventariada"),
            value=F.col("rows"), detail=F.concat(text("columns"), F.lit(" colunas")))),
    }
    return {
        name: _block(sections[source], title, **cells)
        for name, (source, title, cells) in shapes.items()
        if source in sections
    }


def view_export(sections: Mapping[str, DataFrame], view: str) -> DataFrame:
    """The blocks of one view appended to a single long table."""
    blocks = tidy_blocks(sections)
    return reduce(DataFrame.unionByName, [blocks[name] for name in VIEWS[view]])


def view_lines(frame: DataFrame, mark: bool = False) -> DataFrame:
    """The export as text lines below a header line. A cell is quoted only if
    it holds a separator, a quote or a line break; content is not altered.
    ``mark`` puts a byte order mark first, by which spreadsheets know UTF-8."""

    def cell(name: str) -> Column:
        value = F.coalesce(F.col(name), F.lit(""))
        doubled = F.replace(value, F.lit('"'), F.lit('""'))
        wrapped = F.concat(F.lit('"'), doubled, F.lit('"'))
        return F.when(value.rlike('[;"\\n\\r]'), wrapped).otherwise(value)

    first = ("\ufeff" if mark else "") + ";".join(TIDY_COLUMNS)
    header = frame.sparkSession.range(1).select(F.lit(first).alias("line"))
    body = frame.select(F.concat_ws(";", *[cell(c) for c in TIDY_COLUMNS]).alias("line"))
    return header.unionByName(body)


def write_view(frame: DataFrame, path: str, *, mark: bool = False) -> None:
    """One file of semicolon-separated lines ending in CRLF, in view order."""
    placed = view_lines(frame, mark).withColumn("place", F.monotonically_increasing_id())
    ordered = placed.orderBy("place").select("line").coalesce(1)
    ordered.write.mode("errorifexists").option("lineSep", "\r\n").text(path)


def write_document(doc: DataFrame, path: str, checks: DataFrame | None = None) -> None:
    """Publish the JSON document: the contract, the quality gate over ``checks`` and
    the privacy of everything in the text come first, and nothing is written if one
    of them fails."""
    require_sections(doc)
    if checks is not None:
        gate(checks)
    text = materialized(as_json(doc), "document")  # judged and written from one copy
    enforce_document(text)
    text.coalesce(1).write.mode("errorifexists").text(path)
