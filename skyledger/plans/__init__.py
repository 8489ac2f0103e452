"""Read side: daily views, latest-N views and dashboard panels."""
