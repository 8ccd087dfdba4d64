"""DataFrame operators: cleansing, integration, KPIs, windows, quality, documents."""
