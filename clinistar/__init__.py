"""clinistar: a star/snowflake clinical-interaction warehouse and its analyses on Spark.

Entry points: ``clinistar.sources`` (read OLTP tables), ``clinistar.plans.builders``
(build and write the models), ``clinistar.operators.analytics`` (the analyses),
``clinistar.functions.sql.register_sql`` (SQL access), ``clinistar.operators.quality``
and ``clinistar.operators.derive`` (checks and seeded transforms).
"""

__version__ = "0.1.0"
