"""Layer plans: silver per entity, gold metrics, and the role adapters that
map the shared test tables onto the CRM-shaped silver tables."""
