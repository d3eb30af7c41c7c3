"""Plan documents: HTML pages to ordered, typed rows and footnotes."""
