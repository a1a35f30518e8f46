"""Sources and sinks: feature files, history store, versioned publish."""
