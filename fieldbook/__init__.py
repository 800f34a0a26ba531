"""fieldbook: field-survey analytics as Spark DataFrame jobs.

The package turns a roster of people, the form submissions collected from
them and a later baseline survey into a linked master table, an id registry,
self-growing cleaning dictionaries, reconciliation lists, per-person roll-ups
and the tables behind a status-and-demographics report.

Layout:

* ``functions``  column expressions (text, flags, numbers, dates) and
  column-name helpers;
* ``sources``    schemas, fixture views, landed-file reads, versioned publish;
* ``operators``  the reusable jobs (linkage, registry, dictionaries,
  reconciliation, roll-up, histogram, counting);
* ``plans``      the composed first-contact, baseline and report plans and
  the query catalog used by ``__spark_entry__``;
* ``streaming``  incremental ingestion of landed form exports.
"""

__version__ = "0.1.0"
