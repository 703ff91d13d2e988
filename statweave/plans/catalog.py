"""Every registered query: key -> function of (spark, folder of the driver tables)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as fn
from .. import rulebook as R
from ..operators import cuts, flow, inequality, profile, quality, specialization, stock, survey
from ..operators.cleanse import cleanse
from ..session import tuned
from ..sources import feeds, files, landing
from ..sources.scratch import scratch_path
from ..streaming import ledger
from . import gold, indicators, maintained, pipeline, silver
from .lake import Lake
from .versions import Versions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

c = F.col


def register(build: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Lake(tuned(spark), sf_dir))
    return build


def _counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("linhas"))


FLOW_FOLDERS = {"tipo": "string", "competencia": "int"}
FLOW_COLUMNS = pipeline.SOURCES["caged_movimentacao"].columns


def _flow_feed(spark: SparkSession, landed: str) -> ledger.Feed:
    """The landed flow feed with all its columns, and a bronze folder of its own."""
    return ledger.Feed(landed, scratch_path(spark, "bronze"), FLOW_COLUMNS, FLOW_FOLDERS)


def _half_landed(lake: Lake) -> str:
    """A landing whose load stopped after half of the releases."""
    path = scratch_path(lake.spark, "pouso")
    landing.land(lake.spark, lake.flow_events, path, most=landing.releases(lake.flow_raw).count() // 2, finish=feeds.flow_text)
    return path


# --- scans, sources, sinks ---------------------------------------------------------


@register
def ingest_incremental(lake: Lake) -> DataFrame:
    """Two loads of whole rows and a run without new files; every row arrives once."""
    spark = lake.spark
    feed = _flow_feed(spark, scratch_path(spark, "pouso"))
    landing.land(spark, lake.flow_events, feed.landing, ("FOR", "EXC"), finish=feeds.flow_text)
    ledger.ingest(spark, feed)
    landing.land(spark, lake.flow_events, feed.landing, ("MOV",), finish=feeds.flow_text)
    for _ in range(2):
        ledger.ingest(spark, feed)
    return _counts(ledger.rows(spark, feed), "tipo", "competencia")


@register
def ingest_ledger(lake: Lake) -> DataFrame:
    """What the ledger says of every release, beside the rows that came in."""
    spark, feed = lake.spark, _flow_feed(lake.spark, lake.landed_flow())
    ledger.ingest(spark, feed)
    entered = ledger.ledger(spark, feed).groupBy("tipo", "competencia").agg(
        F.sum("linhas").alias("linhas_no_livro"), F.sum("resgatadas").alias("resgatadas"))
    return entered.join(_counts(ledger.rows(spark, feed), "tipo", "competencia"), ["tipo", "competencia"], "full")


@register
def ingest_partitioned(lake: Lake) -> DataFrame:
    schema = files.text_schema(FLOW_COLUMNS, **FLOW_FOLDERS)
    return _counts(files.scan_partitioned(lake.spark, lake.landed_flow(), schema), "tipo", "competencia", "competenciamov")


@register
def ingest_no_partition_cols(lake: Lake) -> DataFrame:
    """The folder says trimestre=0 for every file; the value inside the files is returned."""
    path = scratch_path(lake.spark, "amostra")
    kept = ["ano", "trimestre", "peso"]
    lake.survey_raw.select(*kept).write.parquet(f"{path}/ano=2000/trimestre=0")
    scanned = files.scan_ignoring_folders(lake.spark, path, files.text_schema(kept))
    return _counts(scanned, "ano", "trimestre")


@register
def ingest_audit(lake: Lake) -> DataFrame:
    audited = files.with_audit(files.scan_partitioned(lake.spark, lake.landed_flow()))
    kind = F.regexp_extract("_arquivo_origem", r"tipo=([A-Z]+)/", 1).alias("tipo_no_caminho")
    return audited.groupBy("tipo", kind).agg(
        F.count("_arquivo_origem").alias("com_origem"),
        F.count_if(F.col("_ingerido_em").between(F.current_timestamp() - F.expr("INTERVAL 1 DAY"), F.current_timestamp())).alias("com_horario"),
    )


@register
def rescued_rows(lake: Lake) -> DataFrame:
    """Whole rows of files in which one column is text here and a number there.

    Undeclared columns and texts that are not numbers end up in the rescue column.
    """
    path = scratch_path(lake.spark, "fluxo")
    extra = ["competenciaexc", "indicadordeexclusao"]
    base = lake.flow_raw.withColumn("competencia", c("competencia").cast("string"))
    text = base.withColumn("idade", F.when(c("idade") == "13", F.lit("treze")).otherwise(c("idade")))
    text.where(c("tipo") == "MOV").drop(*extra).write.parquet(f"{path}/a")
    base.where(c("tipo") == "FOR").drop(*extra).withColumn("idade", fn.integer("idade")).write.parquet(f"{path}/b")
    text.where(c("tipo") == "EXC").write.parquet(f"{path}/c")
    declared = files.text_schema([n for n in base.columns if n not in (*extra, "idade")], idade="int")
    scanned = files.scan_rescued(lake.spark, path, declared)
    return scanned.groupBy("tipo").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count("_rescued_data").alias("linhas_resgatadas"),
        F.count(F.get_json_object("_rescued_data", "$.idade")).alias("idades_resgatadas"),
        F.count("idade").alias("idades_convertidas"),
        F.count("salario").alias("com_salario"),
    )


@register
def union_by_name_missing(lake: Lake) -> DataFrame:
    """Releases of one kind carry two more columns than the others."""
    extra = ["competenciaexc", "indicadordeexclusao"]
    base = lake.flow_raw.select("tipo", "competencia", *extra)
    paths = [scratch_path(lake.spark, kind) for kind in ("regular", "exclusoes")]
    base.where(c("tipo") != "EXC").drop(*extra).write.parquet(paths[0])
    base.where(c("tipo") == "EXC").write.parquet(paths[1])
    both = files.union_by_name(*[lake.spark.read.parquet(p) for p in paths])
    return both.groupBy("tipo", "competencia").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count("competenciaexc").alias("com_competenciaexc"),
        F.count("indicadordeexclusao").alias("com_indicador"),
    )


@register
def scan_delimited_text(lake: Lake) -> DataFrame:
    names = ["município", "seção", "salário"]
    source = lake.flow_raw.select("municipio", "secao", "salario").toDF(*names)
    path = files.write_delimited(source, scratch_path(lake.spark, "texto"))
    scanned = files.region_filter(files.scan_delimited(lake.spark, path, names), "município", lake.rules.areas)
    return _counts(files.snake_columns(scanned), "municipio", "secao")


@register
def scan_latin1_csv(lake: Lake) -> DataFrame:
    names = ["Município - Código", "Ind Vínculo Ativo 31/12 - Código"]
    source = lake.stock_raw.select("municipio_codigo", "ind_vinculo_ativo_31_12_codigo").toDF(*names)
    path = files.write_delimited(source, scratch_path(lake.spark, "latin1"), ",", "ISO-8859-1")
    scanned = files.scan_delimited(lake.spark, path, names, ",", "ISO-8859-1")
    return _counts(files.snake_columns(files.region_filter(scanned, names[0], lake.rules.areas)),
                   "municipio_codigo", "ind_vinculo_ativo_31_12_codigo")


@register
def scan_fixed_width(lake: Lake) -> DataFrame:
    path = scratch_path(lake.spark, "largura_fixa")
    lake.survey_raw.select(files.fixed_width_line(R.SURVEY_LAYOUT).alias("value")).write.text(path)
    people = files.scan_fixed_width(lake.spark, path, R.SURVEY_LAYOUT).where(c("rm_ride") == R.METRO_CODE)
    return people.groupBy("ano", "trimestre", "posicao_categoria").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.sum(fn.integer("rendimento_habitual")).alias("soma_rendimento"),
        cuts.money_sum(fn.decimal_point("peso")).alias("soma_peso"),
    )


@register
def scan_prefix_prune(lake: Lake) -> DataFrame:
    path = scratch_path(lake.spark, "estado")
    trimmed = lake.stock_raw.withColumn("cnae_2_0_classe_codigo", F.trim("cnae_2_0_classe_codigo"))
    trimmed.write.parquet(path)
    kept = ["municipio_codigo", "ind_vinculo_ativo_31_12_codigo", "cnae_2_0_classe_codigo"]
    return _counts(files.scan_prefix(lake.spark.read.parquet(path), "cnae_2_0_classe_codigo", "102", kept), *kept)


@register
def dim_from_filenames(lake: Lake) -> DataFrame:
    """Dictionaries written one per domain from the codes the feed uses; lost zeros restored."""
    folder = scratch_path(lake.spark, "dicionarios")
    domains = {"cbo2002ocupacao": c("cbo2002ocupacao").cast("long").cast("string"), "secao": c("secao")}
    for domain, code in domains.items():
        used = lake.flow_raw.groupBy(code.alias("codigo")).agg(F.count(F.lit(1)).alias("n"))
        described = used.select("codigo", F.concat(F.lit("usado "), c("n").cast("string")).alias("descricao"))
        files.write_delimited(described, f"{folder}/caged_{domain}.csv", ",")
    return files.dim_from_filenames(lake.spark, f"{folder}/caged_*.csv", "caged_", {"cbo2002ocupacao": 6})


@register
def dim_from_json_map(lake: Lake) -> DataFrame:
    """One JSON object per folder (class -> section), then the contracts per section."""
    path = scratch_path(lake.spark, "classes")
    lake.classes.agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct(c("cnae_classe").cast("string"), "cnae_secao"))))
    ).write.text(path)
    crosswalk = files.dim_from_json_map(lake.spark, path, "cnae_classe", "cnae_secao")
    used = _counts(lake.stock_raw.select(fn.integer("cnae_2_0_classe_codigo").alias("cnae_classe")), "cnae_classe")
    return used.join(crosswalk, "cnae_classe")


@register
def dim_literal(lake: Lake) -> DataFrame:
    """The 240 (subsector, size) pairs as a table, with the contracts that use each."""
    used = _counts(
        lake.stock_raw.select(
            fn.integer("ibge_subsetor_codigo").alias("ibge_subsetor_codigo"),
            fn.integer("tamanho_estabelecimento_codigo").alias("tamanho_estabelecimento_codigo"),
        ),
        "ibge_subsetor_codigo", "tamanho_estabelecimento_codigo",
    )
    return used.join(lake.sizes, ["ibge_subsetor_codigo", "tamanho_estabelecimento_codigo"])


@register
def dim_typed_csv(lake: Lake) -> DataFrame:
    """Quarterly price factors derived from the sample, written as text and read back typed."""
    path = scratch_path(lake.spark, "deflator")
    factors = lake.survey_raw.groupBy("ano", "trimestre").agg(
        (1 + F.count(F.lit(1)) / 8).cast("string").alias("deflator_habitual")
    )
    files.write_delimited(factors, path, ",")
    return files.dim_typed_csv(lake.spark, path, "ano int, trimestre int, deflator_habitual double")


@register
def query_files(lake: Lake) -> DataFrame:
    return files.query_files(
        lake.spark, lake.landed_flow(), "SELECT tipo, competencia, COUNT(*) AS linhas FROM {files} GROUP BY ALL"
    )


@register
def sink_partitioned(lake: Lake) -> DataFrame:
    """Writing one kind again replaces its folders and leaves the others alone."""
    path = files.write_partitioned(lake.flow_events, scratch_path(lake.spark, "fluxo"), "tipo", "competencia", finish=feeds.flow_text)
    files.write_partitioned(lake.flow_events.where(c("tipo") == "MOV"), path, "tipo", "competencia", finish=feeds.flow_text)
    return _counts(files.scan_partitioned(lake.spark, path), "tipo", "competencia")


@register
def missing_periods(lake: Lake) -> DataFrame:
    """What a load that stopped half way still has to bring, read from the landing itself."""
    return landing.missing_periods(landing.releases(lake.flow_raw), landing.landed_releases(lake.spark, _half_landed(lake)))


@register
def load_summary(lake: Lake) -> DataFrame:
    """The landed side comes from the ledger of a bronze table that took in half of the releases."""
    feed = _flow_feed(lake.spark, _half_landed(lake))
    ledger.ingest(lake.spark, feed)
    summary = landing.load_summary(lake.flow_raw, landing.releases(ledger.ledger(lake.spark, feed)))
    return summary.withColumn("novas_competencias", landing.new_periods(summary).scalar())


@register
def commented_schema(lake: Lake) -> DataFrame:
    """The occupation fact with the meaning of every column attached to it."""
    return files.with_comments(lake.flow_occupations(), gold.comments("caged_ocupacoes"))


@register
def snake_columns(lake: Lake) -> DataFrame:
    names = ["Município - Código", "Tipo Vínculo - Código", "Motivo  Desligamento/Código"]
    source = lake.stock_raw.select("municipio_codigo", "tipo_vinculo_codigo", "motivo_desligamento_codigo")
    renamed = files.snake_columns(source.toDF(*names))
    return _counts(renamed, *renamed.columns)


# --- typing and rules: cleanse() over a whole feed ---------------------------------


def _rule_profile(raw: DataFrame, spec: dict, *originals: str) -> DataFrame:
    """Run cleanse() on the whole feed and count each (original text, treated value) pair."""
    treated = cleanse(raw, spec, keep=originals)
    return _counts(treated, *treated.columns)


@register
def parse_int(lake: Lake) -> DataFrame:
    spec = {"municipio_codigo": fn.integer("municipio"), "grau": fn.integer("graudeinstrucao")}
    return _rule_profile(lake.flow_raw, spec, "municipio", "graudeinstrucao")


@register
def parse_decimal_comma(lake: Lake) -> DataFrame:
    spec = {"salario_informado": fn.decimal_comma("salario"), "horas": fn.decimal_comma("horascontratuais")}
    return _rule_profile(lake.flow_raw, spec, "salario")


@register
def parse_decimal_point(lake: Lake) -> DataFrame:
    spec = {"peso_num": fn.decimal_point("peso"), "renda_num": fn.decimal_point("rendimento_habitual")}
    return _rule_profile(lake.survey_raw, spec, "peso")


@register
def zero_as_null(lake: Lake) -> DataFrame:
    pay = cleanse(lake.stock_raw, {"media": fn.positive_or_null("vl_rem_media_nom"),
                                   "dezembro": fn.positive_or_null("vl_rem_dezembro_nom")}, keep=["ano_base"])
    return pay.groupBy("ano_base").agg(
        F.count(F.lit(1)).alias("linhas"), F.count("media").alias("com_media"), F.count("dezembro").alias("com_dezembro"),
        cuts.money_sum(c("media")).alias("soma_media"), F.min("media").alias("menor_media"),
    )


@register
def conform_labels(lake: Lake) -> DataFrame:
    """The same two labels from the three feeds, each with its own codes."""
    sources = [
        ("fluxo", lake.flow_raw, "sexo", "racacor", lake.rules.flow_sex, lake.rules.flow_race),
        ("estoque", lake.stock_raw, "sexo_codigo", "raca_cor_codigo", lake.rules.stock_sex, lake.rules.stock_race),
        ("amostra", lake.survey_raw, "sexo", "cor_raca", lake.rules.survey_sex, lake.rules.survey_race),
    ]
    parts = [
        _counts(
            df.select(F.lit(name).alias("fonte"), fn.conform_label(s, sexes).alias("sexo"),
                      fn.conform_label(r, races).alias("raca_cor")),
            "fonte", "sexo", "raca_cor",
        )
        for name, df, s, r, sexes, races in sources
    ]
    return files.union_by_name(*parts)


@register
def age_band(lake: Lake) -> DataFrame:
    age = fn.integer("idade")
    return _rule_profile(lake.flow_raw, {"idade_anos": age, "faixa_etaria": fn.age_band(age)}, "idade")


@register
def year_lookup(lake: Lake) -> DataFrame:
    year = fn.period_year(fn.integer("competenciamov"))
    return _rule_profile(lake.flow_raw, {"ano": year, "salario_minimo": fn.year_lookup(year, lake.rules.wages)})


@register
def signed_effect(lake: Lake) -> DataFrame:
    balance = fn.integer("saldomovimentacao")
    return _rule_profile(lake.flow_raw, {"saldo": balance, "efeito": fn.signed_effect(balance, c("tipo"))}, "tipo")


@register
def plausible_value(lake: Lake) -> DataFrame:
    typed = cleanse(lake.flow_raw, *silver.flow_rules(lake.rules))
    year = fn.period_year(c("competencia_mov")).alias("ano")
    return typed.groupBy(year, "unidade_salario_codigo").agg(
        F.count(F.lit(1)).alias("linhas"), F.count("salario_informado").alias("informados"),
        F.count("salario_mensal").alias("plausiveis"), cuts.money_sum(c("salario_mensal")).alias("soma_plausivel"),
        F.min("salario_mensal").alias("menor"), F.max("salario_mensal").alias("maior"),
    )


@register
def ratio_bands(lake: Lake) -> DataFrame:
    typed = cleanse(lake.flow_raw, *silver.flow_rules(lake.rules))
    rated = typed.select(fn.period_year(c("competencia_mov")).alias("ano"),
                         F.try_divide("salario_informado", "salario_minimo").alias("razao"))
    return _counts(rated.withColumn("faixa_salarial_sm", fn.ratio_band(c("razao"))), "ano", "faixa_salarial_sm")


@register
def hour_bands(lake: Lake) -> DataFrame:
    hours = fn.integer("qtd_hora_contr")
    return _rule_profile(lake.stock_raw, {"horas": hours, "faixa_horas": fn.hour_band(hours)})


@register
def code_flags(lake: Lake) -> DataFrame:
    spec = {
        "aprendiz": fn.code_flag(c("categoria"), R.APPRENTICE),
        "tempo_parcial": fn.code_flag(c("indtrabparcial"), "1"),
        "intermitente": fn.code_flag(c("indtrabintermitente"), "1"),
        "tipo_ignorado": fn.code_flag(fn.integer("tipomovimentacao"), 97),
    }
    return _rule_profile(lake.flow_raw, spec)


@register
def rule_set_membership(lake: Lake) -> DataFrame:
    spec = {
        "natureza": fn.integer("natureza_juridica_codigo"),
        "elegivel": fn.in_set(fn.integer("natureza_juridica_codigo"), R.SIZE_ELIGIBLE_NATURES),
        "motivo": fn.integer("motivo_desligamento_codigo"),
        "motivo_excluido": fn.in_set(fn.integer("motivo_desligamento_codigo"), R.NON_TURNOVER_REASONS),
    }
    return _rule_profile(lake.stock_raw, spec)


@register
def turnover_flags(lake: Lake) -> DataFrame:
    typed = cleanse(lake.stock_raw, *silver.stock_rules(lake.rules))
    return _counts(typed, "mes_admissao", "mes_desligamento", "tipo_vinculo_codigo", "motivo_desligamento_codigo",
                   "admissao_rotatividade", "desligamento_rotatividade")


@register
def firm_size(lake: Lake) -> DataFrame:
    return _counts(lake.stock_silver, "ibge_subsetor_codigo", "tamanho_estabelecimento_codigo", "porte")


@register
def eligible_size(lake: Lake) -> DataFrame:
    label = fn.eligible_size(c("elegivel_porte"), c("porte")).alias("porte_oficial")
    return _counts(lake.stock_silver.select("elegivel_porte", "porte", label), "elegivel_porte", "porte", "porte_oficial")


@register
def informality(lake: Lake) -> DataFrame:
    position, registry = fn.integer("posicao_categoria"), fn.integer("negocio_cnpj")
    spec = {"posicao": position, "cnpj": registry, "informal": fn.informality(position, registry)}
    return _rule_profile(lake.survey_raw, spec)


@register
def group_members(lake: Lake) -> DataFrame:
    race = fn.conform_label("cor_raca", lake.rules.survey_race)
    return _rule_profile(lake.survey_raw, {"raca_cor": race, "raca_grupo": survey.race_group(race)}, "cor_raca")


@register
def simple_case_label(lake: Lake) -> DataFrame:
    """Occupation code -> major group; position code -> label."""
    groups = cleanse(lake.stock_raw, {"rotulo": fn.major_group(F.trim("cbo_2002_ocupacao_codigo"))})
    positions = cleanse(lake.survey_raw, {
        "rotulo": fn.simple_case(fn.integer("posicao_categoria"), R.POSITION_LABELS, R.UNKNOWN_F)})
    return files.union_by_name(
        _counts(groups, "rotulo").withColumn("dimensao", F.lit("grande_grupo")),
        _counts(positions, "rotulo").withColumn("dimensao", F.lit("posicao")),
    )


@register
def default_label(lake: Lake) -> DataFrame:
    used = _counts(lake.flow_raw, "cbo2002ocupacao")
    named = flow.described(used, lake.codes, "cbo2002ocupacao", "cbo2002ocupacao", "descricao")
    label = fn.default_label(c("descricao"), F.concat(F.lit(R.OCCUPATION_PREFIX), "cbo2002ocupacao"))
    return named.select("cbo2002ocupacao", label.alias("cbo_descricao"), "linhas")


@register
def region_filter(lake: Lake) -> DataFrame:
    return _counts(files.region_filter(lake.flow_raw, "municipio", lake.rules.areas), "municipio")


@register
def active_only(lake: Lake) -> DataFrame:
    typed = cleanse(lake.stock_raw, *silver.stock_rules(lake.rules))
    return _counts(stock.active_only(typed), "ano_base", "municipio_codigo")


@register
def rolling_window_flag(lake: Lake) -> DataFrame:
    windowed = _counts(flow.in_window(lake.flow_silver), "competencia_mov")
    return windowed.withColumn("preliminar", flow.preliminary(lake.flow_silver))


UNINFORMATIVE = {"bairros_fortaleza_codigo": "999997", "municipio_trab_codigo": "999999",
                 "categoria_trabalhador_codigo": "999"}


@register
def constant_columns(lake: Lake) -> DataFrame:
    """Report of columns with one value or a filler, with the verdict to drop them."""
    report = profile.uninformative_columns(lake.stock_raw, lake.stock_raw.columns, UNINFORMATIVE)
    return report.withColumn("constante", c("distintos") <= 1)


@register
def drop_constant_columns(lake: Lake) -> DataFrame:
    """The contracts without their constant columns: what is left, and how often it is filled in."""
    left = profile.drop_constant_columns(lake.stock_raw)
    counts = left.agg(*[F.count(name).alias(name) for name in left.columns])
    pairs = [F.struct(F.lit(name).alias("coluna"), c(name).alias("preenchidas")) for name in left.columns]
    return counts.select(F.inline(F.array(*pairs)))


@register
def latest_period(lake: Lake) -> DataFrame:
    newest = indicators.latest_period(lake.survey_silver)
    return _counts(newest, "ano", "trimestre", "mora_em_fortaleza")


# --- joins --------------------------------------------------------------------------


@register
def join_inner_dim(lake: Lake) -> DataFrame:
    """Only areas of the dimension remain: the inner join is also the region filter."""
    typed = cleanse(lake.flow_raw, {"municipio_codigo": fn.integer("municipio")})
    return _counts(typed, "municipio_codigo").join(lake.areas, "municipio_codigo")


@register
def join_left_domain(lake: Lake) -> DataFrame:
    used = _counts(lake.flow_raw.select(c("secao").alias("cnae_secao")), "cnae_secao")
    return flow.described(used, lake.codes, "secao", "cnae_secao", "cnae_secao_descricao")


@register
def join_expr_key(lake: Lake) -> DataFrame:
    """Join on computed keys: the year of a month, and a number against a text code."""
    typed = cleanse(lake.flow_raw, {"competencia_mov": fn.integer("competenciamov"),
                                    "grau": fn.integer("graudeinstrucao")})
    wages = feeds.wages(lake.spark)
    joined = _counts(typed, "competencia_mov", "grau").join(wages, fn.period_year(c("competencia_mov")) == c("ano"), "left")
    return flow.described(joined, lake.codes, "graudeinstrucao", "grau", "escolaridade").select(
        "competencia_mov", "grau", "escolaridade", c("valor").alias("salario_minimo"), "linhas")


@register
def join_left_using(lake: Lake) -> DataFrame:
    typed = cleanse(lake.stock_raw, {"cnae_classe": fn.integer("cnae_2_0_classe_codigo")})
    return _counts(typed, "cnae_classe").join(lake.classes, "cnae_classe", "left")


@register
def join_left_composite(lake: Lake) -> DataFrame:
    used = _counts(lake.survey_silver, "ano", "trimestre")
    return used.join(lake.deflators, ["ano", "trimestre"], "left")


@register
def join_cross_scalar(lake: Lake) -> DataFrame:
    """Every month beside the newest on-time month, without a cross join."""
    newest = fn.month_index(flow.last_month(lake.flow_silver))
    return _counts(lake.flow_silver, "competencia_mov").withColumn(
        "meses_ate_a_ultima", (newest - fn.month_index(c("competencia_mov"))).cast("int"))


@register
def join_aggregates(lake: Lake) -> DataFrame:
    """Area counts beside the counts of the whole, two aggregates of one scan."""
    stocked = lake.regional_stock()
    area = stocked.groupBy("ano_base", "municipio_codigo").agg(F.sum("vinculos_ativos").alias("vinculos_area"))
    whole = stocked.groupBy("ano_base").agg(F.sum("vinculos_ativos").alias("vinculos_total"))
    return area.join(whole, "ano_base")


# --- aggregations -------------------------------------------------------------------


@register
def flow_fact(lake: Lake) -> DataFrame:
    return lake.flow()


def _maintained(lake: Lake) -> tuple[Versions, ledger.Feed]:
    """The stored flow fact after three landings of a third of the releases each, and the feed; built once a session."""
    spark, key = lake.spark, (lake.spark.sparkContext.applicationId, lake.sf_dir)
    if key not in _KEPT:
        feed = replace(pipeline.feed(scratch_path(spark, "pouso"), scratch_path(spark, "bronze"), "caged_movimentacao", lake.rules), max_files=10**6)
        fact = maintained.stored(scratch_path(spark, "fato"))
        third = -(-landing.releases(lake.flow_raw).count() // 3)
        for _ in range(3):
            landing.land(spark, lake.flow_events, feed.landing, most=third, finish=feeds.flow_text)
            ledger.ingest(spark, feed)
            maintained.follow(spark, fact, feed, lambda raw: silver.flow_silver(raw, lake.rules), lake.rules.wages)
        _KEPT[key] = (fact, feed)
    return _KEPT[key]


_KEPT: dict[tuple[str, str], tuple[Versions, ledger.Feed]] = {}


@register
def maintained_flow(lake: Lake) -> DataFrame:
    """The same fact from stored months that three landings brought up to date."""
    return maintained.published(lake.spark, _maintained(lake)[0], lake.areas, lake.codes)


@register
def maintained_revisions(lake: Lake) -> DataFrame:
    """Revisions of the stored months, without a look at the events."""
    return maintained.late_revisions(lake.spark, _maintained(lake)[0])


@register
def flow_by_occupation(lake: Lake) -> DataFrame:
    return lake.flow_occupations()


@register
def group_by_all(lake: Lake) -> DataFrame:
    return lake.spark.sql(
        "SELECT tipo, competencia, COUNT(*) AS linhas FROM {flow} GROUP BY ALL", flow=lake.flow_raw
    )


@register
def median_cube(lake: Lake) -> DataFrame:
    return lake.medians()


@register
def stock_fact(lake: Lake) -> DataFrame:
    return lake.stock()


@register
def stock_by_occupation(lake: Lake) -> DataFrame:
    return lake.stock_occupations()


@register
def gini(lake: Lake) -> DataFrame:
    return inequality.gini(lake.stock_plain, lake.areas, region=lake.rules.region)


@register
def turnover_rate(lake: Lake) -> DataFrame:
    return inequality.turnover_rate(lake.stock_plain, lake.areas, lake.rules.region)


@register
def inequality_turnover(lake: Lake) -> DataFrame:
    return lake.inequality()


@register
def regional_stock(lake: Lake) -> DataFrame:
    return lake.regional_stock()


@register
def location_quotient(lake: Lake) -> DataFrame:
    return lake.quotients()


def _settled(df: DataFrame) -> DataFrame:
    """Weighted sums without the last-bit noise of summation order."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({name: F.round(name, 4) for name in doubles})


@register
def weighted_components(lake: Lake) -> DataFrame:
    return _settled(lake.components())


@register
def weighted_income(lake: Lake) -> DataFrame:
    components = lake.components("ano", "trimestre", "raca_grupo")
    return _settled(components.select("ano", "trimestre", "raca_grupo", *survey.INCOME_SUMS))


@register
def survey_rates(lake: Lake) -> DataFrame:
    return lake.rates()


@register
def ratio_of_group_means(lake: Lake) -> DataFrame:
    """Women's mean over men's in every row of the cube, also where sex is the total."""
    means = survey.aggregate_cuts(lake.components(), lake.rules.region)
    pct = cuts.ratio(c("renda_mulher"), c("renda_homem"), 3, 100)
    return means.select(*survey.RATE_KEYS, pct.alias("razao_renda_mulher_homem_pct"))


@register
def weighted_by_category(lake: Lake) -> DataFrame:
    return lake.positions()


@register
def rollup_of_components(lake: Lake) -> DataFrame:
    return _settled(survey.rollup_components(lake.components(), ["ano", "sexo"]))


@register
def revision_reach(lake: Lake) -> DataFrame:
    return profile.revision_reach(lake.flow_raw, "tipo", "competenciamov", "200101")


@register
def conditional_counts(lake: Lake) -> DataFrame:
    return profile.conditional_counts(lake.flow_raw, ["tipo"], {
        "sem_idade": c("idade").isNull(), "salario_ilegivel": fn.decimal_comma("salario").isNull(),
        "aprendizes": c("categoria") == R.APPRENTICE})


@register
def percentile_profile(lake: Lake) -> DataFrame:
    return profile.percentile_profile(
        lake.flow_raw, ["unidadesalariocodigo"], fn.decimal_comma("salario"), {"p1": 0.01, "p50": 0.5, "p99": 0.99})


@register
def cast_success(lake: Lake) -> DataFrame:
    return profile.cast_success(lake.flow_raw, "salario")


@register
def extremes_profile(lake: Lake) -> DataFrame:
    return profile.extremes_profile(lake.flow_raw, fn.decimal_comma("salario"), 1000.0, 100000.0)


def _wage_of_the_year(lake: Lake) -> Column:
    return fn.year_lookup(fn.period_year(fn.integer("competenciamov")), lake.rules.wages)


@register
def band_profile(lake: Lake) -> DataFrame:
    pay, wage = fn.decimal_comma("salario"), _wage_of_the_year(lake)
    edges = [(0.1, "2. abaixo de 0,1 SM"), (0.3, "3. 0,1 a 0,3 SM"), (0.5, "4. 0,3 a 0,5 SM")]
    band = F.when(pay.isNull(), "0. ilegível").when(pay == 0, "1. zero").when(wage.isNull(), "7. ano sem SM")
    for edge, label in edges:
        band = band.when(pay < wage * edge, label)
    band = band.when(pay <= wage * 30.0, "5. 0,5 a 30 SM").otherwise("6. acima de 30 SM")
    monthly = lake.flow_raw.where(c("unidadesalariocodigo") == R.MONTHLY_UNIT)
    return profile.band_profile(monthly, band, fn.decimal_comma("horascontratuais"), c("indtrabparcial") == "1")


@register
def rule_impact(lake: Lake) -> DataFrame:
    pay, wage = fn.decimal_comma("salario"), _wage_of_the_year(lake)
    monthly = lake.flow_raw.where(c("unidadesalariocodigo") == R.MONTHLY_UNIT)
    return profile.rule_impact(monthly, pay, {
        "simples": pay > 0, "plausivel": pay.between(wage * R.WAGE_FLOOR, wage * R.WAGE_CEILING)})


@register
def sentinel_counts(lake: Lake) -> DataFrame:
    return files.union_by_name(
        profile.sentinel_counts(lake.flow_raw, {
            "categoria = 999": c("categoria") == "999", "graudeinstrucao = 80": c("graudeinstrucao") == "80"}),
        profile.sentinel_counts(lake.stock_raw, {"remuneração = .00": c("vl_rem_media_nom") == ".00"}),
        profile.sentinel_counts(lake.survey_raw, {
            "sem condição na força de trabalho": c("condicao_forca_trabalho").isNull(),
            "desses, menos de 14 anos": c("condicao_forca_trabalho").isNull() & (fn.integer("idade") < R.WORKING_AGE)}),
    )


@register
def code_frequency(lake: Lake) -> DataFrame:
    return profile.code_frequency({
        "fluxo": (lake.flow_raw, "racacor"), "estoque": (lake.stock_raw, "raca_cor_codigo"),
        "amostra": (lake.survey_raw, "cor_raca")})


@register
def sample_size(lake: Lake) -> DataFrame:
    return survey.sample_size(lake.survey_raw, fn.decimal_point("peso"), c("condicao_ocupacao") == "2")


@register
def status_counts(lake: Lake) -> DataFrame:
    return profile.counts_by(lake.stock_raw, "ind_vinculo_ativo_31_12_codigo")


@register
def reconcile_counts(lake: Lake) -> DataFrame:
    """Counts in the ledger of the landed contracts against those of the source they were cut from."""
    spec = pipeline.SOURCES["rais_vinculo"]
    feed = ledger.Feed(scratch_path(lake.spark, "estoque"), scratch_path(lake.spark, "bronze"), spec.columns, spec.folders)
    kept = lake.stock_raw.select("ano_base", *spec.columns).where(c("vl_rem_media_nom") != ".00")
    files.write_partitioned(kept, feed.landing, "ano_base")
    ledger.ingest(lake.spark, feed)
    found = ledger.ledger(lake.spark, feed).groupBy("ano_base").agg(F.sum("linhas").alias("linhas"))
    expected = lake.stock_raw.groupBy("ano_base").agg(F.count(F.lit(1)).alias("esperado"))
    return profile.reconcile(found, ["ano_base"], expected)


# --- windows, sorts, set operations -------------------------------------------------


@register
def share_of_total(lake: Lake) -> DataFrame:
    return cuts.share_of_total(
        lake.regional_stock().where(c("cnae_secao").isNotNull()), ["cnae_secao"], c("vinculos_ativos"))


@register
def sorted_output(lake: Lake) -> DataFrame:
    return _counts(lake.flow_raw, "tipo", "competenciamov").orderBy("tipo", F.desc("competenciamov"))


@register
def top_k(lake: Lake) -> DataFrame:
    return indicators.top_k(_counts(lake.flow_raw, "salario"), ["salario"], "linhas", "n", 5)


@register
def overlapping_cuts(lake: Lake) -> DataFrame:
    both = survey.overlapping_cuts(lake.components("ano", "trimestre", "area"), lake.rules.region)
    return both.groupBy("recorte", "ano", "trimestre").agg(
        F.sum("pessoas_amostra").alias("pessoas_amostra"), F.round(F.sum("populacao"), 2).alias("populacao"))


@register
def union_all(lake: Lake) -> DataFrame:
    """Rows without a readable value in each of the three feeds."""

    def count(name: str, df: DataFrame, missing) -> DataFrame:
        return df.agg(F.lit(name).alias("tabela"), F.count(F.lit(1)).alias("linhas"), F.count_if(missing).alias("sem_valor"))

    return files.union_by_name(
        count("fluxo", lake.flow_raw, fn.decimal_comma("salario").isNull()),
        count("estoque", lake.stock_raw, fn.positive_or_null("vl_rem_media_nom").isNull()),
        count("amostra", lake.survey_raw, fn.decimal_point("rendimento_habitual").isNull()),
    )


@register
def late_revisions(lake: Lake) -> DataFrame:
    return flow.late_revisions(lake.flow_silver)


# --- quality ------------------------------------------------------------------------


@register
def expect_or_drop(lake: Lake) -> DataFrame:
    """The kept rows of every area, and beside them what each check dropped."""
    typed, checks = cleanse(lake.flow_raw, *silver.flow_rules(lake.rules)), silver.flow_checks(lake.rules)[0]
    kept = quality.expect_or_drop(typed, checks).groupBy("municipio_codigo").agg(
        F.count(F.lit(1)).alias("linhas"), F.sum("efeito").alias("efeito"))
    dropped = quality.drop_report(typed, checks).select("expectativa", c("violacoes").alias("descartadas"), "so_por_ela")
    return files.union_by_name(kept, dropped)


@register
def quality_history(lake: Lake) -> DataFrame:
    """What the checks found in each of three landings."""
    history = ledger.quality_history(lake.spark, _maintained(lake)[1])
    return history.select(F.col("_lote").alias("lote"), "expectativa", "linhas", "violacoes")


@register
def expect_report(lake: Lake) -> DataFrame:
    dropping, measured = silver.flow_checks(lake.rules)
    return quality.expect_report(cleanse(lake.flow_raw, *silver.flow_rules(lake.rules)), {**dropping, **measured})


@register
def gold_constraints(lake: Lake) -> DataFrame:
    """Identities and ranges the gold tables must keep."""
    return gold.constraint_report({
        "caged_fluxo": lake.flow(),
        "caged_salario_mediano": lake.medians(),
        "rais_estoque": lake.stock(),
        "rais_indicadores_municipio": lake.inequality(),
        "pnad_mercado_trabalho": lake.components(),
        "pnad_indicadores": lake.rates(),
    })


@register
def expect_conditional(lake: Lake) -> DataFrame:
    """A missing firm size is an alarm only outside public administration."""
    check = {"tem_porte": silver.stock_checks(lake.rules)[1]["tem_porte"]}
    everyone = {"tem_porte_sem_excecao": c("porte").isNotNull()}
    return quality.expect_report(lake.stock_silver, {**check, **everyone})


@register
def reliability_flag(lake: Lake) -> DataFrame:
    sample = lake.components("ano", "trimestre", "faixa_etaria", "area")
    return sample.select("ano", "trimestre", "faixa_etaria", "area", "desocupados_amostra",
                         quality.reliable(c("desocupados_amostra")).alias("amostra_suficiente"))


# --- indicators ---------------------------------------------------------------------


@register
def q_balance_by_area(lake: Lake) -> DataFrame:
    return indicators.balance_by_area(lake.flow("municipio_nome", "faixa_etaria"))


# The driver tables have few hires per sector, so their floor is lower than that of the published table.
MEDIAN_BAND, MEDIAN_MINIMUM, MEDIAN_AREA = "30+", 3, "NATION_4"


@register
def q_median_by_sector(lake: Lake) -> DataFrame:
    return indicators.median_by_sector(
        lake.medians(["periodo", "municipio_nome", "sexo"], faixa_etaria=MEDIAN_BAND), MEDIAN_BAND, MEDIAN_MINIMUM)


@register
def q_top_sectors(lake: Lake) -> DataFrame:
    return indicators.top_sectors(lake.flow("cnae_secao_descricao", "faixa_etaria"))


@register
def q_monthly_balance(lake: Lake) -> DataFrame:
    return indicators.monthly_balance(lake.flow("competencia_mov", "preliminar"))


@register
def q_median_point(lake: Lake) -> DataFrame:
    return indicators.median_point(
        lake.medians(["periodo", "sexo", "cnae_secao_descricao"], municipio_nome=MEDIAN_AREA, faixa_etaria="18-24"), MEDIAN_AREA)


@register
def q_latest_rate(lake: Lake) -> DataFrame:
    return indicators.latest_rate(lake.rates())


@register
def q_compare_areas(lake: Lake) -> DataFrame:
    return indicators.compare_areas(lake.rates())


@register
def q_mean_by_size(lake: Lake) -> DataFrame:
    return indicators.mean_by_size(lake.stock("porte_oficial"))


@register
def q_share_of_total(lake: Lake) -> DataFrame:
    return indicators.hire_shares(lake.flow("faixa_etaria", "aprendiz"))


@register
def q_stock_profile(lake: Lake) -> DataFrame:
    return indicators.stock_profile(lake.stock(
        "ano_base", "grau_instrucao_codigo", "escolaridade", "faixa_etaria", "sexo", "raca_cor", "faixa_horas",
        "faixa_renda_sm"))


@register
def q_ratio_of_sums(lake: Lake) -> DataFrame:
    return indicators.ratio_of_sums(lake.stock("cnae_secao_descricao"), lake.stock_occupations("grande_grupo"))


@register
def q_pay_gaps(lake: Lake) -> DataFrame:
    return indicators.pay_gaps(lake.stock("ano_base", "sexo", "raca_cor", "porte_oficial"))


@register
def q_deflated_mean(lake: Lake) -> DataFrame:
    return indicators.deflated_mean(lake.rates())


@register
def q_share_over_time(lake: Lake) -> DataFrame:
    return indicators.share_over_time(lake.components("ano", "trimestre", "sexo"))


@register
def q_by_band(lake: Lake) -> DataFrame:
    return indicators.by_pay_band(lake.flow("faixa_salarial_sm"))


@register
def q_small_firm_share(lake: Lake) -> DataFrame:
    return indicators.small_firm_share(lake.stock("cnae_secao_descricao", "porte_oficial"))


@register
def q_top_occupations(lake: Lake) -> DataFrame:
    return indicators.top_occupations(lake.flow_occupations("cbo_codigo", "cbo_descricao"))


@register
def q_stock_occupations(lake: Lake) -> DataFrame:
    return indicators.stock_occupations(lake.stock_occupations("cbo_codigo", "cbo_descricao"))


@register
def q_hire_profile(lake: Lake) -> DataFrame:
    return indicators.hire_profile(lake.flow("faixa_etaria", "escolaridade", "sexo", "raca_cor"))


@register
def q_work_quality(lake: Lake) -> DataFrame:
    return indicators.work_quality(lake.rates())


@register
def q_cross_profile(lake: Lake) -> DataFrame:
    return indicators.cross_profile(lake.stock("escolaridade", "sexo"))


@register
def q_rank_areas(lake: Lake) -> DataFrame:
    return indicators.rank_areas(lake.inequality(), lake.quotients())
