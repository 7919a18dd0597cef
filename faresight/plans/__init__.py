"""Named analyses over the supplied tables (the ``queries()`` catalog) and
multi-step plans such as the retrain decision."""
