"""Write the layers as tables, in dependency order, each read back by the next."""

from __future__ import annotations

from shelfline.lakehouse import Lakehouse
from shelfline.plans import cells, explore, export, gold, quality, silver
from shelfline.sources import schemas
from shelfline.sources.tables import replace_clustered, replace_summary_view, replace_table

# Table comments.
COMMENTS = {
    "financial_transactions_clean": "Transactions financières nettoyées et validées",
    "promotions_clean": "Promotions nettoyées avec dates validées",
    "customer_demographics_clean": "Démographiques clients nettoyés et validés",
    "employee_records_clean": "Dossiers employés nettoyés avec calcul d'ancienneté",
    "supplier_information_clean": "Informations fournisseurs nettoyées avec catégorisation",
    "logistics_and_shipping_clean": "Données logistiques nettoyées avec indicateurs de performance",
    "customer_service_interactions_clean": "Interactions service client nettoyées avec indicateurs",
    "marketing_campaigns_clean": "Campagnes marketing nettoyées avec indicateurs d'efficacité",
    "product_reviews_clean": "Avis produits nettoyés avec analyse de sentiment",
    "inventory_clean": "Inventaire structuré avec indicateurs de stock",
    "store_locations_clean": "Localisations magasins avec indicateurs opérationnels",
    "sales_enriched": "Table centrale des ventes enrichies avec promotions et campagnes marketing actives",
    "promotions_active": "Catalogue des promotions actives et historiques avec métriques de performance",
    "customers_enriched": "Base clients enrichie avec données démographiques et comportementales",
    "marketing_performance": "Performance détaillée des campagnes marketing avec ROI et métriques d'efficacité",
}
COLUMN_COMMENTS = {
    "promotions_active": {
        "roi_percentage": "Return on Investment de la promotion: (Revenu net - Coût remises) * 100 / Coût remises",
        "market_share_pct": "Part de marché capturée par la promotion pendant sa période d'activité",
    }
}

# Views for SQL users: name, the plan behind it and the order of its rows. The export view is one over its written factors.
VIEWS = {
    "business_dashboard": (explore.business_dashboard, ""),
    "monthly_report_data": (explore.monthly_report, ""),
    "daily_sales_summary": (gold.daily_sales_summary, ""),
    "v_daily_region_sales": (gold.daily_region_sales, ""),
    "v_current_promotions": (quality.current_promotions, "end_date, roi_percentage DESC NULLS FIRST, promotion_id"),
    "v_promotion_performance_summary": (
        quality.promotion_status_summary,
        "coalesce(nullif(array_position(array('Active', 'Scheduled', 'Completed'), promotion_status), 0), 4)",
    ),
    "v_top_performing_campaigns": (quality.top_performing_campaigns, "roi_percentage DESC, generated_revenue DESC, campaign_name"),
}
EXPORT = "sales_analysis_export"
# View comments.
VIEW_COMMENTS = {
    "daily_sales_summary": "Résumé quotidien des ventes par région. Usage: Dashboards, monitoring quotidien, reporting opérationnel.",
    "v_current_promotions": "Vue des promotions actuellement actives avec jours restants et métriques de performance.",
    "v_promotion_performance_summary": "Résumé des performances des promotions par statut.",
    "v_top_performing_campaigns": "Top 20 des campagnes marketing les plus performantes par ROI et revenu généré.",
}


def build(lake: Lakehouse, prefix: str = "") -> None:
    """Write every Bronze, Silver and Gold table to databases of these names, serve them from there, create the views.

    Written tables cut the lineage: a lost executor costs a re-read, not a re-run of the cleaning. The views lie in the Gold
    database, readable by every session of the catalogue, as of this build like the tables; this session also knows them
    by their bare names.
    """
    spark = lake.spark
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}")
    for name in schemas.BRONZE_TABLES:
        lake.use("bronze", name, replace_table(lake.bronze(name), f"{prefix}bronze.{name}"))
    for name in silver.TABLES:
        table = replace_table(lake.silver(name), f"{prefix}silver.{name}", COMMENTS[name])
        lake.use("silver", name, table)
    for name, layout in cells.TABLES.items():
        lake.use("gold", name, replace_clustered(getattr(cells, name)(lake), f"{prefix}gold.{name}", layout))
    for name, layout in gold.CLUSTERING.items():
        table = replace_clustered(lake.gold(name), f"{prefix}gold.{name}", layout, COMMENTS[name], COLUMN_COMMENTS.get(name))
        lake.use("gold", name, table)
    for name, (plan, order) in VIEWS.items():
        view = replace_summary_view(plan(lake), f"{prefix}gold.{name}", VIEW_COMMENTS.get(name), order)
        view.createOrReplaceTempView(name)
    export.create_export_view(lake, f"{prefix}gold.{EXPORT}").createOrReplaceTempView(EXPORT)
