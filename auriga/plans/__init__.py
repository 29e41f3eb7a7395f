"""KPI sets, question sets, layer refreshes and the catalogue of registered queries."""
