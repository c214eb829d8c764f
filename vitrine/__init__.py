"""vitrine: labelled-catalogue image analytics as Spark DataFrame transformations.

Typical use::

    from vitrine.session import build_session          # or your own SparkSession
    from vitrine.sources.tables import Catalogue
    from vitrine.operators import catalog, assets, splits, scoring
    from vitrine.plans import flows

    spark = build_session()
    cat = Catalogue.from_tables(spark, "/data/sf0.1")   # or Catalogue.from_jdbc(spark, profile)
    images = catalog.with_image_url(catalog.labelled_images(cat, attribute_type_id=708))
    manifest = assets.attach_assets(images.withColumnRenamed("varchar_value", "label"),
                                    cat.landed_assets)

    flows.land_training_images(cat, "/landing")          # job 1, end to end

Modules: ``sources`` (tables, files, JDBC), ``sinks``, ``functions`` (column functions),
``operators`` (DataFrame -> DataFrame steps), ``plans`` (registered queries, flows),
``streaming`` (incremental feature fill).
"""
__version__ = "0.1.0"
